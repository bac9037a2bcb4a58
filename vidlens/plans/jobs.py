"""Jobs a user calls (J2-J7); J1 is :func:`vidlens.sources.crawl.load_crawls`.

A job returns lazy DataFrames; with ``out_dir`` it also writes every result
with the Spark writers.  The cleaned table is materialised once (Parquet under
the caller's path) and all results read it, so lineage is cut there.
"""

from __future__ import annotations

import os
from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens import schema as S
from vidlens.operators import clean, filters, stats, topn, trends
from vidlens.plans import charts
from vidlens.plans.grains import GRAINS, GROUP_LIMIT, Grains, Leaders
from vidlens.sinks import writers

PARTS = ("statistics", "top", "categories", "trends", "related", "charts")
# Results whose size follows the data (one row per category, per day, per
# video): written by every task in parallel, as a CSV folder (B1).
PARALLEL_OUTPUTS = ("category_stats", "trends", "related_analysis", "chart_category_views",
                    "chart_category_ratings", "chart_daily_trend")


def load_and_store(spark, root: str, out_dir: str, strict: bool = False) -> dict:
    """J1 end to end: crawl tree -> Parquet video table + accounting table.

    The text is read and parsed once, into a staged table; the deduplicated
    videos are written from it with their source folder and file, and the
    accounting takes its ``kept`` counts from the stored videos.  The stage is
    deleted when both are written.  The accounting rows (a handful per file)
    are written as one CSV.  Returns the paths and the total row.
    """
    from vidlens.session import scratch
    from vidlens.sources import crawl
    table = os.path.join(out_dir, "videos")
    with scratch(spark, "crawl-stage") as folder:
        lines, logs = crawl.read_crawl_lines(spark, root), crawl.read_crawl_logs(spark, root)
        staged = crawl.stage_crawls(lines, logs, f"{folder}/lines")
        if strict:
            crawl.raise_on_bad(staged)
        videos = crawl.first_videos(staged)
        stored_cols = [f.name for f in crawl.video_table(videos).schema.fields] + ["folder", "file_name"]
        writers.write_parquet(videos.select(*[F.col(c) for c in stored_cols]), table)
        acc = crawl.crawl_accounting(staged, spark.read.parquet(table))
        return _store_accounting(spark, acc, table, out_dir)


def _store_accounting(spark, acc: DataFrame, table: str, out_dir: str) -> dict:
    accounting = os.path.join(out_dir, "accounting")
    writers.write_csv(acc, accounting)
    total = spark.read.schema(acc.schema).option("header", "true").csv(accounting) \
        .where(F.col("folder").isNull()).first()
    return {"videos": table, "accounting": accounting, "totals": total.asDict() if total else {}}


def clean_videos(videos: DataFrame, coerce: bool = True) -> DataFrame:
    """C1 + C2: typed metrics with defaults; ``related_ids`` is kept."""
    df = clean.coerce_numeric(videos) if coerce else videos
    return clean.fill_defaults(df)


def prepare(videos: DataFrame, path: str, partition_by=None) -> DataFrame:
    """J4 stage 1: clean and store as Parquet, then read the stored table."""
    writers.write_parquet(clean_videos(videos), path, partition_by=partition_by)
    return videos.sparkSession.read.parquet(path)


def statistics(df: DataFrame) -> dict[str, DataFrame]:
    """F1-F5 and the B6 table."""
    summary = stats.summary_statistics(df)
    tr, mw = stats.top_rated(df), stats.most_watched(df)
    return {"summary": summary, "top_rated": tr, "most_watched": mw,
            "statistics": writers.statistics_table(summary, tr, mw)}


def top_tables(df: DataFrame, n=S.TOP_N_DEFAULT) -> dict[str, DataFrame]:
    """G1-G3; an N given as text is validated."""
    k = topn.validate_n(n) if isinstance(n, str) else int(n)
    return {f"top_{k}_views": topn.top_views(df, k), f"top_{k}_ratings": topn.top_rating(df, k),
            f"top_{k}_comments": topn.top_comments(df, k)}


def chart_datasets(df: DataFrame, length_path: str | None = None) -> dict[str, DataFrame]:
    """Every chart dataset in one call (``length_path``: see :func:`charts.views_by_length`)."""
    out = {"category_views": charts.category_views(df),
           "category_ratings": charts.category_ratings(df),
           "monthly_trend": charts.monthly_trend(df),
           "daily_trend": charts.daily_trend(df),
           "top_videos": charts.top_videos(df),
           "correlation_table": charts.correlation_table(df)}
    out.update({f"views_{k}": v for k, v in charts.views_distribution(df).items()})
    out.update({f"length_{k}": v for k, v in charts.views_by_length(df, length_path).items()})
    return out


def _lazy_results(df: DataFrame, parts: set, k: int) -> dict[str, DataFrame]:
    """Every result with a plan of its own over ``df``."""
    res: dict[str, DataFrame] = {}
    if "statistics" in parts:
        res.update(statistics(df))
    if "top" in parts:
        res.update(top_tables(df, k))
    if "categories" in parts:
        res["category_stats"] = stats.category_stats(df)
    if "trends" in parts:
        res["trends"] = trends.daily_trend(df)
    if parts & set(CHART_READS):
        res.update({f"chart_{name}": d for name, d in chart_datasets(df).items() if f"chart_{name}" in parts})
    return res


_METRIC_GRAINS = ("views", "rating", "comments_count")
#: What each chart's dataset reads: grains, and whether it reads the rankings.
CHART_READS = {"chart_category_views": (("category",), False), "chart_category_ratings": (("category",), False),
               "chart_monthly_trend": (("age",), False), "chart_daily_trend": (("age",), False),
               "chart_top_videos": (_METRIC_GRAINS, True), "chart_correlation_table": (("whole",), False),
               "chart_views_histogram": (("views",), False), "chart_views_density": (("views",), False),
               "chart_length_summary": (("views",), False), "chart_length_density": (("views",), False)}
#: The same for the other parts of a report.
PART_READS = {"statistics": (("whole", *_METRIC_GRAINS), True), "top": (_METRIC_GRAINS, True),
              "categories": (("category",), False), "trends": (("age",), False)} | CHART_READS


def _fused_results(df: DataFrame, out_dir: str, parts: set, k: int) -> dict[str, DataFrame]:
    """The same results from the stored grains and rankings of ``df``.

    The table is scanned once for the grains, once for all rankings and once
    for the correlations, however many results there are.
    """
    needed = {name for p in parts for name in PART_READS[p][0]}
    if not needed:
        return {}
    g = Grains.build(df, os.path.join(out_dir, "grains"), needed)
    deep = k > GROUP_LIMIT  # a ranking that long is an ordinary top-k with a scan of its own
    leaders = None
    if any(PART_READS[p][1] for p in parts):
        wide = S.TOP_N_DEFAULT if "chart_top_videos" in parts else 1
        leaders = Leaders.build(df, g, os.path.join(out_dir, "leaders"),
                                max(wide, k if "top" in parts and not deep else 1))
    res: dict[str, DataFrame] = {}
    if "statistics" in parts:
        summary, tr, mw = g.summary(), leaders.top("rating", 1), leaders.top("views", 1)
        res.update({"summary": summary, "top_rated": tr, "most_watched": mw,
                    "statistics": writers.statistics_table(summary, tr, mw)})
    if "top" in parts:
        res.update(top_tables(df, k) if deep else {
            f"top_{k}_views": leaders.top("views", k), f"top_{k}_ratings": leaders.top("rating", k),
            f"top_{k}_comments": leaders.top("comments_count", k)})
    if "categories" in parts:
        res["category_stats"] = g.category_stats()
    if "trends" in parts:
        res["trends"] = g.daily_trend()
    charted = {
        "chart_category_views": lambda: g.category_stats(drop_null_keys=True, order="desc").select("category", "avg_views"),
        "chart_category_ratings": lambda: g.category_stats(drop_null_keys=True, order="desc").select("category", "avg_rating"),
        "chart_monthly_trend": g.monthly_trend,
        "chart_daily_trend": lambda: trends.reaggregate_trend(g.daily_trend(ordered=False)),
        "chart_top_videos": lambda: leaders.top("views", S.TOP_N_DEFAULT).select("video_id", "views"),
        "chart_correlation_table": lambda: stats.correlation_pairs(df, means=g.means()),
        "chart_views_histogram": lambda: charts.views_distribution(g.values(), "value", weight="n")["histogram"],
        "chart_views_density": lambda: charts.views_distribution(g.values(), "value", weight="n")["density"],
        "chart_length_summary": lambda: g.lengths().summary(),
        "chart_length_density": lambda: g.lengths().density()}
    res.update({name: charted[name]() for name in CHART_READS if name in parts})
    return res


def report(df: DataFrame, out_dir: str | None = None, top_n=S.TOP_N_DEFAULT,
           parts: Iterable[str] = PARTS) -> dict[str, DataFrame]:
    """Statistics, top-N, category statistics, trends, related
    analysis and chart datasets from one (cleaned) table.

    ``parts`` selects what to build (J6 is ``("statistics", "top")``); a single
    chart goes by the name of its dataset, as ``"chart_daily_trend"``.  Without
    ``out_dir`` nothing runs and each result has a plan of its own.  With it
    each result is written as one CSV folder (overwrite), and all are read from
    two Parquet tables written beside them, ``grains`` and ``leaders``: the
    table is scanned at most four times, for the grains, the rankings, the
    correlations and the related ids (a ``top_n`` over ``GROUP_LIMIT`` has
    three scans of its own).
    """
    parts = set(parts)
    unknown = parts - set(PARTS) - set(CHART_READS)
    if unknown:
        raise ValueError(f"unknown parts of a report: {sorted(unknown)}")
    k = topn.validate_n(top_n) if isinstance(top_n, str) else int(top_n)
    related = "related" in parts and "related_ids" in df.columns
    if "charts" in parts:
        parts |= set(CHART_READS)
    parts -= {"related", "charts"}
    res = _fused_results(df, out_dir, parts, k) if out_dir else _lazy_results(df, parts, k)
    if related:
        res["related_analysis"] = clean.related_as_text(df)
    if out_dir:
        for name, d in res.items():
            if name in ("summary", "top_rated", "most_watched"):
                continue
            if name in PARALLEL_OUTPUTS:
                writers.write_csv(d, os.path.join(out_dir, name))
            else:
                # bounded by construction (5 statistics, the wanted top rows,
                # chart datasets of fixed bins, points and pairs, months)
                writers.write_single_csv(d, os.path.join(out_dir, name))
    return res


TREND_SCHEMA = "upload_date string, avg_views double, avg_rating double"


def trends_from_csv(spark, path: str) -> DataFrame:
    """A10 + C6 + C7 + G6 (+ F11): a published trend CSV read back tolerantly
    (too-wide rows skipped), incomplete rows dropped, dates parsed, one row per
    date, ascending."""
    from vidlens.sources import tables
    return trends.reaggregate_trend(tables.read_csv_tolerant(spark, path, TREND_SCHEMA))


def interactive_slice(df: DataFrame, ranges: Mapping[str, object] | None = None,
                      page_number: int = 0, size: int = S.PAGE_SIZE,
                      sort_col: str | None = None, ascending: bool = True) -> DataFrame:
    """Text or tuple ranges (D2) -> filter (D1) -> one page."""
    return topn.page(filters.range_filter(df, ranges), page_number, size,
                     sort_col=sort_col, ascending=ascending)


def page_info(df: DataFrame, size: int = S.PAGE_SIZE) -> dict:
    """Row and page totals for a (filtered) table -- one count action."""
    n = df.count()
    return {"rows": n, "pages": topn.page_count(n, size)}
