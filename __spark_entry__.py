"""

``entry(spark)`` runs the flagship query (category statistics) on sf0.001.
``queries()`` holds one callable per implemented operator group, each reading
the whole driver tables through the video adapter; ``oracle_sql()`` gives the
same result as DuckDB SQL.  Floating results are rounded to 6 places on both
sides (averages differ in the last digits between engines and runs).
"""

from __future__ import annotations

import importlib.util
import math
import os
import sys
from collections.abc import Callable
from itertools import combinations

# importable from anywhere: the package sits next to this file
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schema as S
from vidlens.operators import clean, distribution, filters, stats, topn, trends
from vidlens.plans import adapter, charts
from vidlens.sources import crawl

SMOKE_DIR = "/root/testdata/sf0.001"
DIGITS = 6
CURVE_DIGITS = 5


def _round(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), DIGITS).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _curve(df: DataFrame) -> DataFrame:
    """Densities to five places: they are within a bound of the sum over all rows, not equal to it."""
    return _round(df.withColumn("density", F.round("density", CURVE_DIGITS)))


def _videos(spark, sf):
    return adapter.videos(spark, sf)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: average views and rating per category on sf0.001."""
    return _round(stats.category_stats(_videos(spark, SMOKE_DIR)))


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------
PAIR_NAMES = ("feature_1", "feature_2", "correlation", "abs_correlation")
COUNTED = [("category", "=", "R"), ("views", ">", 1000), ("uploader", "=", "u7"), ("rating", "=", 5.0)]
RANGES = {"age": (100, 1500), "views": "60000-5000", "rating": (1.0, 3.0)}


def _crawl(spark, sf):
    lines = adapter.crawl_lines(spark, sf)
    return crawl.load_crawls(lines=lines, logs=adapter.crawl_logs(adapter.crawl_lines(spark, sf, deal=None)))


def q_crawl_parse(spark, sf):
    p = crawl.parse_crawl_lines(adapter.crawl_lines(spark, sf)).where(F.col("status") == "ok")
    return _round(p.select("folder", "file_name", "line_pos", *S.CRAWL_FIELDS,
                           F.size("related_ids").alias("n_related"),
                           F.concat_ws(",", "related_ids").alias("related")))


def q_crawl_load(spark, sf):
    videos, _ = _crawl(spark, sf)
    return _round(videos.select(*S.CRAWL_FIELDS, F.concat_ws(",", "related_ids").alias("related"),
                                "crawl_date", "folder", "file_name", "line_pos"))


def q_crawl_accounting(spark, sf):
    _, acc = _crawl(spark, sf)
    return acc


def q_coerce_numeric(spark, sf):
    ev = adapter.table(spark, sf, "events")
    kind = (F.col("event_id") % 4).cast("int")
    raw = (F.when(kind == 0, F.col("value").cast("string"))
            .when(kind == 1, F.col("props"))
            .when(kind == 2, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(" "), F.floor("value").cast("string"), F.lit(" "))))
    t = ev.select("event_id", kind.alias("kind"), raw.alias("views"), raw.alias("rating"))
    return _round(clean.coerce_numeric(t, {"views": 0, "rating": 0}, integer=["views"]))


def q_fill_defaults(spark, sf):
    docs = adapter.table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = adapter.table(spark, sf, "labels")
    return clean.fill_defaults(docs.join(lab, "doc_id", "left"), {"quality": 0, "toxic": -1})


def q_related_string(spark, sf):
    v = adapter.videos(spark, sf, related=True)
    return clean.related_as_text(v.select("video_id", "related_ids"))


def q_dedup_first(spark, sf):
    v = adapter.videos(spark, sf, related=True).drop("related_ids")
    return _round(clean.dedup_first(v, order=["crawl_date"]))


def q_csv_roundtrip(spark, sf):
    from vidlens import scratch_path
    from vidlens.sinks import writers
    from vidlens.sources import tables
    path = writers.write_csv(stats.category_stats(_videos(spark, sf)), scratch_path(spark, "csv-roundtrip"))
    back = tables.read_csv_result(spark, path, "category string, avg_views double, avg_rating double")
    return _round(back)


def q_json_roundtrip(spark, sf):
    from vidlens import scratch_path
    from vidlens.sources import tables
    path = scratch_path(spark, "json-roundtrip")
    adapter.videos(spark, sf, related=True).write.mode("overwrite").json(path)
    back = tables.read_json_videos(spark, path)
    return _round(back.select(*S.CRAWL_FIELDS, F.concat_ws(",", "related_ids").alias("related"), "crawl_date"))


def q_parquet_roundtrip(spark, sf):
    from vidlens import scratch_path
    from vidlens.plans import jobs
    stored = jobs.prepare(adapter.videos(spark, sf, related=True), scratch_path(spark, "prepared"),
                          partition_by=["category"])
    return _round(stored.select(*S.CRAWL_FIELDS, F.concat_ws(",", "related_ids").alias("related"), "crawl_date"))


def q_metric_export(spark, sf):
    from vidlens.sinks import writers
    v = _videos(spark, sf)
    return writers.statistics_table(stats.summary_statistics(v), stats.top_rated(v), stats.most_watched(v))


def q_related_correlation(spark, sf):
    from vidlens.plans import charts
    rel = charts.related_counts(adapter.videos(spark, sf, related=True)).drop("related_ids")
    return _round(charts.related_correlation(rel))


def q_interactive_slice(spark, sf):
    from vidlens.plans import jobs
    return _round(jobs.interactive_slice(_videos(spark, sf), {"age": "0-2000", "views": "", "rating": "4.5-2"}, 1))


def _tolerant(spark, sf):
    """A10 over CSV part files made from lineitem: quoted commas, too-wide
    rows (skipped) and one-field rows (kept with a null)."""
    from vidlens import scratch_path
    from vidlens.sources import tables
    li = adapter.table(spark, sf, "lineitem")
    ln, ok, pk = F.col("l_linenumber"), F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    line = (F.when(ln == 1, F.concat(F.lit('"x,'), ok, F.lit('",'), pk))
             .when(ln == 2, F.concat_ws(",", ok, pk, F.col("l_suppkey").cast("string")))
             .when(ln == 3, ok)
             .when(ln == 4, F.concat(F.lit('"y,'), ok, F.lit('",'), pk, F.lit(",9")))
             .otherwise(F.concat_ws(",", ok, pk)))
    path = scratch_path(spark, "tolerant-csv")
    li.select(line.alias("value")).write.mode("overwrite").text(path)
    return tables.read_csv_tolerant(spark, path, "a string, b string", header=False)


def q_tolerant_csv(spark, sf):
    return _tolerant(spark, sf)


def q_tolerant_csv_one_column(spark, sf):
    """A10 where only one column is read: the same rows count."""
    t = _tolerant(spark, sf)
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.count("a").alias("n_a"), F.count_if(F.col("a").contains(",")).alias("n_commas"))


def q_category_normalised(spark, sf):
    """Category twins (spaced, HTML-escaped) made from lineitem rows fall
    into one group when normalised."""
    v = _videos(spark, sf)
    ln = F.substring(F.col("video_id"), -1, 1)
    cat = (F.when(ln == "3", F.concat(F.lit(" "), F.col("category"), F.lit(" ")))
            .when(ln == "4", F.concat(F.col("category"), F.lit(" &amp; x")))
            .when(ln == "5", F.concat(F.col("category"), F.lit(" & x")))
            .otherwise(F.col("category")))
    return _round(stats.category_stats(v.withColumn("category", cat), normalise=True))


def _views_histogram(spark, sf):
    return _round(distribution.log_histogram(_videos(spark, sf)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "category_stats": lambda s, d: _round(stats.category_stats(_videos(s, d))),
    "category_stats_ranked": lambda s, d: _round(
        stats.category_stats(_videos(s, d), drop_null_keys=True, order="desc")),
    "top_views": lambda s, d: _round(topn.top_views(_videos(s, d), 10)),
    "top_rating": lambda s, d: _round(topn.top_rating(_videos(s, d), 10)),
    "top_comments": lambda s, d: _round(topn.top_comments(_videos(s, d), 10)),
    "summary_statistics": lambda s, d: _round(stats.summary_statistics(_videos(s, d))),
    "most_watched": lambda s, d: _round(stats.most_watched(_videos(s, d))),
    "top_rated": lambda s, d: _round(stats.top_rated(_videos(s, d))),
    "trend_daily": lambda s, d: _round(trends.daily_trend(_videos(s, d))),
    "trend_monthly": lambda s, d: _round(trends.monthly_trend(_videos(s, d))),
    "trend_reaggregate": lambda s, d: _round(trends.reaggregate_trend(trends.daily_trend(_videos(s, d)))),
    "range_filter": lambda s, d: _round(filters.range_filter(_videos(s, d), RANGES)),
    "counted_queries": lambda s, d: filters.count_matches(_videos(s, d), COUNTED),
    "quantile_band": lambda s, d: _round(filters.quantile_band(filters.length_window(_videos(s, d)))),
    "length_ranges": lambda s, d: _round(distribution.length_range_summary(_videos(s, d))),
    "correlation_pairs": lambda s, d: _round(stats.correlation_pairs(_videos(s, d), names=PAIR_NAMES)),
    "correlation_matrix": lambda s, d: _round(stats.correlation_matrix(_videos(s, d))),
    "views_histogram": _views_histogram,
    "views_density": lambda s, d: _curve(distribution.log_density(_videos(s, d))),
    "dedup_first": q_dedup_first,
    "coerce_numeric": q_coerce_numeric,
    "fill_defaults": q_fill_defaults,
    "related_string": q_related_string,
    "page": lambda s, d: _round(topn.page(_videos(s, d), 2, 100)),
    "page_deep": lambda s, d: _round(topn.page(_videos(s, d), 450, 100)),
    "crawl_parse": q_crawl_parse,
    "crawl_load": q_crawl_load,
    "crawl_accounting": q_crawl_accounting,
    "quantiles": lambda s, d: _round(stats.quantiles(_videos(s, d), "views", [0.01, 0.25, 0.5, 0.75, 0.99])),
    "trend_daily_valid": lambda s, d: _round(trends.daily_trend(_videos(s, d), valid_only=True)),
    "top_views_25": lambda s, d: _round(topn.top_views(_videos(s, d), "25")),
    "length_density": lambda s, d: _curve(distribution.length_range_density(_videos(s, d))),
    "related_correlation": q_related_correlation,
    "interactive_slice": q_interactive_slice,
    "csv_roundtrip": q_csv_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "metric_export": q_metric_export,
    "tolerant_csv": q_tolerant_csv,
    "tolerant_csv_one_column": q_tolerant_csv_one_column,
    "category_normalised": q_category_normalised,
    "chart_category_views": lambda s, d: _round(charts.category_views(_videos(s, d))),
    "chart_category_views_asc": lambda s, d: _round(charts.category_views(_videos(s, d), order="asc")),
    "chart_category_ratings": lambda s, d: _round(charts.category_ratings(_videos(s, d))),
    "chart_top_videos": lambda s, d: charts.top_videos(_videos(s, d)),
}


def _dirty(spark, sf):
    """The video view with what clean data lacks: null categories, zero views,
    NaN ratings and lengths of a minute and less."""
    n = F.col("comments_count")
    return _videos(spark, sf).select(
        "video_id", "uploader", "age",
        F.when(n % 7 != 0, F.col("category")).alias("category"),
        F.when(n % 5 == 0, F.col("length") % 61).otherwise(F.col("length")).alias("length"),
        F.when(n % 11 == 0, F.lit(0)).otherwise(F.col("views")).cast("bigint").alias("views"),
        F.when(n % 13 == 0, F.lit(float("nan"))).otherwise(F.col("rating")).alias("rating"),
        "comments_count")


def q_length_chart(spark, sf):
    """H7 from one stored directory: a range's box statistics and where its curve stands highest."""
    from vidlens.session import scratch_path
    chart = charts.views_by_length(_videos(spark, sf), scratch_path(spark, "length-counts"))
    peak = chart["density"].where("density = 1").groupBy("length_range").agg(
        F.min("point").alias("peak_point"), F.min("x").alias("peak_x"))
    return _round(chart["summary"].join(peak, "length_range", "left"))


def q_page_indexed(spark, sf):
    """G8 by a stored rank index over a first column with few values."""
    from vidlens.session import scratch_path
    v = _videos(spark, sf)
    index = topn.PageIndex.build(v, scratch_path(spark, "page-index"), ["category"], stride=256)
    return _round(index.page(v, 13, 70))


def q_csv_reversible(spark, sf):
    """A9/B1 without loss: texts with nulls, empty strings, line breaks and quotes, read back from split files."""
    from vidlens.session import scratch_path
    from vidlens.sinks import writers
    docs = adapter.table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.when(
        F.col("doc_id") % 5 != 0, F.col("text")).otherwise("")).alias("text"))
    path = writers.write_csv_reversible(docs, scratch_path(spark, "csv-reversible"))
    return writers.read_csv_reversible(spark, path, "doc_id long, text string")


def q_published_parts(spark, sf):
    """B3 over many parts: all videos in order as one file, read back."""
    from vidlens.session import scratch_path
    from vidlens.sinks import writers
    from vidlens.sources import tables
    path = writers.publish_csv(_videos(spark, sf).select("video_id", "views", "category"), scratch_path(spark, "parts"),
                               "videos", ["views", "video_id"])
    return tables.read_csv_result(spark, path, "video_id string, views long, category string")


def _report(spark, sf, parts=("statistics", "top", "categories", "trends"), related=False):
    """A report written to files; returns its folder."""
    from vidlens.plans import jobs
    from vidlens.session import scratch_path
    folder = scratch_path(spark, "report")
    jobs.report(adapter.videos(spark, sf, related=True) if related else _videos(spark, sf), folder, parts=parts)
    return folder


def _from_report(name, schema, part):
    """A result of a report, read back from its file."""
    def query(spark, sf):
        from vidlens.sources import tables
        folder = _report(spark, sf, (part,))
        back = tables.read_csv_result(spark, f"{folder}/{name}", schema)
        return _curve(back) if "density" in back.columns else _round(back)
    return query


def q_report_statistics(spark, sf):
    """J6 and B6, read back from the report's file."""
    from vidlens.sources import tables
    return tables.read_csv_result(spark, f"{_report(spark, sf)}/statistics", "metric string, value string")


def q_report_top(spark, sf):
    """The report's top list, read back."""
    from vidlens.sources import tables
    schema = _videos(spark, sf).schema
    return _round(tables.read_csv_result(spark, f"{_report(spark, sf)}/top_{S.TOP_N_DEFAULT}_views", schema))


def q_report_trends(spark, sf):
    """The report's trend file read back tolerantly and aggregated again."""
    from vidlens.plans import jobs
    return _round(jobs.trends_from_csv(spark, f"{_report(spark, sf)}/trends"))


def q_sink_modes(spark, sf):
    """A rerun replaces its own output, ``errorifexists`` refuses."""
    from pyspark.errors import AnalysisException
    from vidlens.session import scratch_path
    from vidlens.sinks import writers
    from vidlens.sources import tables
    result, path, refused = stats.category_stats(_videos(spark, sf)), scratch_path(spark, "modes"), False
    for _ in range(2):
        writers.write_csv(result, path)
    try:
        writers.write_csv(result, path, mode="errorifexists")
    except AnalysisException:
        refused = True
    back = tables.read_csv_result(spark, path, "category string, avg_views double, avg_rating double")
    return back.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("refused", F.lit(refused))


def _crawl_tree(spark, sf):
    """J1 from files: a written crawl tree, its files split over several tasks, staged once."""
    from vidlens.session import scratch_path
    root = adapter.write_crawl_tree(spark, sf, scratch_path(spark, "crawl-tree"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(adapter.split_bytes(spark, root, before)))
    try:
        videos, accounting = crawl.load_crawls(spark, root, stage=scratch_path(spark, "crawl-stage"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    name = F.element_at(F.split("folder", "/"), -1)
    return videos.withColumn("folder", name), accounting.withColumn("folder", name)


def q_crawl_load_files(spark, sf):
    """A1-A4, C8 and J1 over files; one folder has no log, one log no date."""
    videos, _ = _crawl_tree(spark, sf)
    return _round(videos.select(*S.CRAWL_FIELDS, F.concat_ws(",", "related_ids").alias("related"),
                                "crawl_date", "folder", "file_name"))


def q_crawl_accounting_files(spark, sf):
    """C9 over the same files."""
    return _crawl_tree(spark, sf)[1]


def q_trend_of_text(spark, sf):
    """C6, C7 and F11 over a trend with text dates, repeated dates and nulls."""
    t = _videos(spark, sf).select(
        F.when(F.col("age") >= 0, F.date_format(F.date_sub(F.lit("2008-01-01").cast("date"), "age"), "yyyy-MM-dd")).alias("upload_date"),
        F.when(F.col("comments_count") % 7 != 0, F.col("views")).alias("avg_views"),
        F.col("rating").alias("avg_rating"))
    return _round(trends.reaggregate_trend(t))


def q_published_file(spark, sf):
    """Category means published as one named file, read back."""
    from vidlens.session import scratch_path
    from vidlens.sinks import writers
    from vidlens.sources import tables
    folder = scratch_path(spark, "published")
    path = writers.publish_csv(_round(stats.category_stats(_videos(spark, sf))), folder, "by_category", ["category"])
    return tables.read_csv_result(spark, path, "category string, avg_views double, avg_rating double")


def q_projected_scan(spark, sf):
    """The generic reader with the analysis columns, over a stored table."""
    from vidlens.session import scratch_path
    from vidlens.sources import tables
    path = scratch_path(spark, "projected")
    adapter.videos(spark, sf, related=True).write.json(path)
    return _round(tables.read_videos(spark, "json", path))


def q_drop_related(spark, sf):
    """C3 on the table with related ids: every other column is left, so one not dropped would show."""
    return _round(clean.drop_related(adapter.videos(spark, sf, related=True)))


def q_report_related(spark, sf):
    """The related ids written by the report, read back (an empty text comes back null)."""
    from vidlens.sources import tables
    folder, v = _report(spark, sf, ("related",), related=True), adapter.videos(spark, sf, related=True)
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "related_ids" else f.dataType)
                           for f in v.schema.fields])
    back = tables.read_csv_result(spark, f"{folder}/related_analysis", schema)
    return back.select("video_id", F.coalesce("related_ids", F.lit("")).alias("related_ids"))


def _chart_of_report(name, schema, columns=None):
    """A chart's dataset written by the report, read back."""
    query = _from_report(f"chart_{name}", schema, f"chart_{name}")
    return lambda spark, sf: query(spark, sf).select(*(columns or ["*"]))


VIDEO_COLS = ("video_id", "uploader", "age", "category", "length", "views", "rating", "comments_count")
QUERIES |= {
    "top_views_500": lambda s, d: _round(topn.top_views(_videos(s, d), 500)),
    "page_sorted": lambda s, d: _round(topn.page(_videos(s, d), 2, 100, sort_col="views", ascending=False)),
    "range_reversed_pair": lambda s, d: _round(filters.range_filter(_videos(s, d), {"age": (1500, 100)})),
    "range_fractional_pair": lambda s, d: _round(filters.range_filter(_videos(s, d), {"views": (20000.5, 30000.5)})),
    "preview": lambda s, d: _round(topn.preview(topn.sort_by(_videos(s, d), "video_id"))),
    "page_indexed": q_page_indexed,
    "length_chart": q_length_chart,
    "report_statistics": q_report_statistics,
    "report_top": q_report_top,
    "report_trends": q_report_trends,
    "report_category_stats": _from_report("category_stats", "category string, avg_views double, avg_rating double", "categories"),
    "report_related": q_report_related,
    "report_chart_views": _chart_of_report("category_views", "category string, avg_views double"),
    "report_chart_ratings": _chart_of_report("category_ratings", "category string, avg_rating double"),
    "report_chart_months": _chart_of_report("monthly_trend", "upload_month date, avg_views double, avg_rating double"),
    "report_chart_days": _chart_of_report("daily_trend", "upload_date date, avg_views double, avg_rating double"),
    "report_chart_top": _chart_of_report("top_videos", "video_id string, views long"),
    "report_chart_correlations": _chart_of_report(
        "correlation_table", ", ".join(f"{c} {t}" for c, t in zip(PAIR_NAMES, ("string", "string", "double", "double")))),
    "report_chart_histogram": _chart_of_report("views_histogram", "bin int, bin_lo double, bin_hi double, count long"),
    "report_chart_density": _chart_of_report(
        "views_density", "point int, log_x double, x double, density double, count_density double",
        ["point", "log_x", "x", "density"]),
    "report_chart_lengths": _chart_of_report(
        "length_summary", "length_range string, range_order int, n long, min double, q1 double, median double, q3 double, max double"),
    "report_chart_shapes": _chart_of_report("length_density", "length_range string, point int, x double, density double"),
    "sink_modes": q_sink_modes,
    "csv_reversible": q_csv_reversible,
    "published_parts": q_published_parts,
    "page_first_key_null": lambda s, d: _round(topn.page(_dirty(s, d), 450, 50, order_by=["category", "rating"])),
    "crawl_load_files": q_crawl_load_files,
    "crawl_accounting_files": q_crawl_accounting_files,
    "trend_of_text": q_trend_of_text,
    "published_file": q_published_file,
    "projected_scan": q_projected_scan,
    "drop_related": q_drop_related,
    "dirty_category_stats": lambda s, d: _round(stats.category_stats(_dirty(s, d), drop_null_keys=True)),
    "dirty_category_null": lambda s, d: _round(stats.category_stats(_dirty(s, d))),
    "dirty_top_rating": lambda s, d: _round(topn.top_rating(_dirty(s, d), 200)),
    "dirty_length_ranges": lambda s, d: _round(distribution.length_range_summary(_dirty(s, d))),
    "dirty_histogram": lambda s, d: _round(distribution.log_histogram(_dirty(s, d))),
    "dirty_density": lambda s, d: _curve(distribution.log_density(_dirty(s, d))),
    "dirty_daily_trend": lambda s, d: _round(trends.daily_trend(_dirty(s, d))),
}


def _llm_present() -> bool:
    """The training-data subpackage and its pipeline may be left out."""
    return all(importlib.util.find_spec(m) for m in ("vidlens.llm", "corpus_pipeline"))


def _llm_queries() -> dict:
    if not _llm_present():
        return {}
    import corpus_pipeline
    from vidlens.llm import queries as llm
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}


def _llm_oracle() -> dict:
    if not _llm_present():
        return {}
    import corpus_pipeline
    from vidlens.llm import queries as llm
    return llm.ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | _llm_queries()


# --------------------------------------------------------------------------
# DuckDB side
# --------------------------------------------------------------------------
_AGE = "cast(datediff('day', cast(l_shipdate as date), date '2001-01-01') as integer)"
_VIDEOS = f"""videos as (
  select concat(l_orderkey, '-', l_linenumber) as video_id,
         concat('u', l_suppkey) as uploader,
         {_AGE} as age,
         l_returnflag as category,
         cast(floor(l_quantity * 75) as integer) as length,
         cast(floor(l_extendedprice) as bigint) as views,
         l_discount * 50 as rating,
         cast(l_partkey % 100 as integer) as comments_count
  from lineitem)"""
_VCOLS = ["video_id", "uploader", "age", "category", "length", "views", "rating", "comments_count"]


def _r(expr: str, name: str) -> str:
    return f"round({expr}, {DIGITS}) as {name}"


def _vsel(prefix: str = "") -> str:
    return ", ".join(_r(f"{prefix}rating", "rating") if c == "rating" else f"{prefix}{c}" for c in _VCOLS)


def _top_sql(metric: str, n: int) -> str:
    rest = ", ".join(c for c in _VCOLS if c != metric)
    return (f"with {_VIDEOS}, t as (select * from videos order by {metric} desc nulls last, {rest} limit {n}) "
            f"select {_vsel()} from t")


def _pairs_sql() -> str:
    parts = [f"select '{a}' as feature_1, '{b}' as feature_2, corr({a}, {b}) as r from videos"
             for a, b in combinations(S.CORRELATION_COLUMNS, 2)]
    return (f"with {_VIDEOS}, p as ({' union all '.join(parts)}) "
            f"select feature_1, feature_2, {_r('r', 'correlation')}, {_r('abs(r)', 'abs_correlation')} "
            f"from p where r is not null and not isnan(r)")


def _matrix_sql() -> str:
    cols = ["age", "length", "views", "rating", "comments_count"]
    parts = [f"select '{a}' as x, '{b}' as y, corr({a}, {b}) as r from videos" for a in cols for b in cols]
    return f"with {_VIDEOS}, p as ({' union all '.join(parts)}) select x, y, {_r('r', 'r')} from p"


_LEN_CASE = " ".join(
    f"when length > {lo} and length <= {hi} then '{lab}'"
    for lo, hi, lab in zip(S.LENGTH_EDGES[:-1], S.LENGTH_EDGES[1:], S.LENGTH_LABELS))
_LEN_ORDER = " ".join(
    f"when length > {lo} and length <= {hi} then {i}"
    for i, (lo, hi) in enumerate(zip(S.LENGTH_EDGES[:-1], S.LENGTH_EDGES[1:])))
_BAND = f"""w as (select * from videos where length > 0 and length < 3600),
  b as (select quantile_cont(views, 0.01) as lo, quantile_cont(views, 0.99) as hi from w),
  band as (select w.* from w, b where w.views between b.lo and b.hi)"""

_DAILY = "select date '2008-01-01' - age as upload_date, avg(views) as avg_views, avg(rating) as avg_rating from videos group by 1"

_SQRT2PI = repr(math.sqrt(2 * math.pi))
_DENSITY = f"""with {_VIDEOS},
  p as (select log10(views) as lv from videos where views > 0),
  s as (select count(*) as n, min(lv) as lo, max(lv) as hi, stddev_samp(lv) as sd from p),
  s2 as (select n, lo, hi, sd * pow(cast(n as double), -0.2) as h, (hi - lo) / 199 as step from s),
  t as (select cast(r.i as integer) as point, lo + r.i * step as x,
               exp(-0.5 * pow((lo + r.i * step - lv) / h, 2)) as t, n, h
        from p, s2, (select range as i from range(200)) r)
select point, {_r('x', 'log_x')}, {_r('pow(10.0, x)', 'x')},
       round(sum(t) / (n * h * {_SQRT2PI}), {CURVE_DIGITS}) as density
from t group by point, x, n, h"""

_HIST = f"""with {_VIDEOS},
  p as (select log10(views) as lv from videos where views > 0),
  s as (select min(lv) as lo0, max(lv) as hi0 from p),
  s2 as (select case when lo0 = hi0 then lo0 - 0.5 else lo0 end as lo,
                case when lo0 = hi0 then hi0 + 0.5 else hi0 end as hi from s),
  c as (select least(cast(floor((lv - lo) / (hi - lo) * 50) as integer), 49) as bin, count(*) as cnt
        from p, s2 group by 1),
  g as (select cast(range as integer) as bin from range(50))
select g.bin, {_r('pow(10.0, lo + g.bin * ((hi - lo) / 50))', 'bin_lo')},
       {_r('pow(10.0, lo + (g.bin + 1) * ((hi - lo) / 50))', 'bin_hi')},
       coalesce(c.cnt, 0) as count
from g cross join s2 left join c on g.bin = c.bin"""

# crawl lines made from lineitem, as in vidlens.plans.adapter.crawl_lines
_LINES = f"""lines as (
  select concat('c', year(l_shipdate)) as folder,
         concat(l_linenumber % 4, '.txt') as file_name,
         l_orderkey as line_pos,
         l_linenumber as ln,
         [concat(l_orderkey, '-', l_linenumber), concat('u', l_suppkey),
          case when l_linenumber = 6 then concat('x', {_AGE}) else cast({_AGE} as varchar) end,
          l_returnflag, cast(cast(floor(l_quantity * 75) as bigint) as varchar),
          cast(cast(floor(l_extendedprice) as bigint) as varchar), cast(l_discount * 50 as varchar),
          cast(cast(floor(l_tax * 1000) as bigint) as varchar), cast(l_partkey % 100 as varchar)] as fixed,
         l_partkey, l_suppkey, l_orderkey
  from lineitem),
  raw as (
  select folder, file_name, line_pos,
         case when ln = 7 then array_to_string(fixed[1:5], chr(9))
              when ln = 5 then array_to_string(fixed, chr(9)) || chr(9) || chr(9)
              when ln <= 2 then array_to_string(fixed, chr(9)) || chr(9) || 'p' || l_partkey || chr(9) || 's' || l_suppkey || chr(9) || 'o' || l_orderkey
              else array_to_string(fixed, chr(9)) || chr(9) || 'p' || l_partkey end as value
  from lines),
  split as (
  select folder, file_name, line_pos,
         string_split(regexp_replace(value, '^\\s+|\\s+$', '', 'g'), chr(9)) as parts
  from raw),
  parsed as (
  select folder, file_name, line_pos, len(parts) as nf,
         parts[1] as video_id, parts[2] as uploader, try_cast(parts[3] as integer) as age,
         parts[4] as category, try_cast(parts[5] as integer) as length,
         try_cast(parts[6] as bigint) as views, try_cast(parts[7] as double) as rating,
         try_cast(parts[8] as bigint) as ratings_count, try_cast(parts[9] as bigint) as comments_count,
         case when len(parts) > 9 then parts[10:] else [] end as rel
  from split),
  status as (
  select *, case when nf < 9 then 'short'
                 when age is null or length is null or views is null or rating is null
                      or ratings_count is null or comments_count is null then 'bad'
                 else 'ok' end as status
  from parsed)"""

_LOGDATES = """folders as (select distinct folder from lines),
  dates as (select folder, case when folder = 'c1998' then null
                                else substr(folder, 4, 2) || '0101' end as crawl_date from folders)"""

_CRAWL_FIELDS = ", ".join(["video_id", "uploader", "age", "category", "length", "views",
                           _r("rating", "rating"), "ratings_count", "comments_count"])

_CRAWLED = f"""with {_LINES}, {_LOGDATES},
  dated as (select s.*, d.crawl_date,
                   case when d.crawl_date is null then 'skipped' else s.status end as st
            from status s left join dates d using (folder)),
  ranked as (select *, row_number() over (
                 partition by video_id order by crawl_date, folder, file_name, line_pos,
                 uploader, age, category, length, views, rating, ratings_count, comments_count, rel) as rn
             from dated where st = 'ok')"""

_RELVIDEOS = f"""rv as (
  select concat(l_orderkey, '-', l_linenumber) as video_id, concat('u', l_suppkey) as uploader,
         {_AGE} as age, l_returnflag as category, cast(floor(l_quantity * 75) as integer) as length,
         cast(floor(l_extendedprice) as bigint) as views, l_discount * 50 as rating,
         cast(floor(l_tax * 1000) as bigint) as ratings_count, cast(l_partkey % 100 as integer) as comments_count,
         case when l_linenumber = 1 or l_linenumber = 7 then '' else concat('p', l_partkey, ',s', l_suppkey) end as related,
         strftime(l_shipdate, '%y%m%d') as crawl_date,
         case when l_linenumber = 1 then 0 when l_linenumber = 7 then 0 else 2 end as related_count
  from lineitem)"""
_RV_SELECT = ("video_id, uploader, {age} as age, category, {length} as length, views, round(rating, 6) as rating, "
              "ratings_count, {cc} as comments_count, related, crawl_date")


def _related_corr_sql() -> str:
    cols = ["age", "length", "views", "rating", "ratings_count", "comments_count", "related_count"]
    rows = []
    for a in cols:
        sel = ", ".join(f"round(corr({a}, {b}), 6) as {b}" for b in cols)
        rows.append(f"select '{a}' as x, {sel} from rv")
    return f"with {_RELVIDEOS} " + " union all ".join(rows)


_LDENS = f"""with {_VIDEOS}, {_BAND},
  t as (select case {_LEN_CASE} end as length_range, cast(views as double) as lv from band),
  s as (select length_range, count(*) as n, min(lv) as lo, max(lv) as hi, stddev_samp(lv) as sd
        from t where length_range is not null group by 1),
  s1 as (select *, sd * pow(cast(n as double), -0.2) as h from s),
  s2 as (select length_range, n, lo, hi, h,
                lo - 2.0 * h as g0,
                case when (hi + 2.0 * h) > (lo - 2.0 * h) then ((hi + 2.0 * h) - (lo - 2.0 * h)) / 99 else 0.0 end as step
         from s1),
  k as (select length_range, cast(r.i as integer) as point, g0 + r.i * step as x,
               exp(-0.5 * pow((g0 + r.i * step - lv) / h, 2)) as t, n, h
        from t join s2 using (length_range), (select range as i from range(100)) r),
  d as (select length_range, point, x, sum(t) / (n * h * {_SQRT2PI}) as density from k
        group by length_range, point, x, n, h)
select length_range, point, {_r('x', 'x')},
       round(density / max(density) over (partition by length_range), {CURVE_DIGITS}) as density from d"""

ORACLE: dict[str, str] = {
    "category_stats": f"with {_VIDEOS} select category, {_r('avg(views)', 'avg_views')}, "
                      f"{_r('avg(rating)', 'avg_rating')} from videos group by category",
    "category_stats_ranked": f"with {_VIDEOS} select category, {_r('avg(views)', 'avg_views')}, "
                             f"{_r('avg(rating)', 'avg_rating')} from videos where category is not null "
                             f"group by category order by avg_views desc",
    "top_views": _top_sql("views", 10),
    "top_rating": _top_sql("rating", 10),
    "top_comments": _top_sql("comments_count", 10),
    "summary_statistics": f"with {_VIDEOS} select count(*) as total_videos, "
                          f"{_r('avg(views)', 'average_views')}, {_r('median(views)', 'median_views')} from videos",
    "most_watched": _top_sql("views", 1),
    "top_rated": _top_sql("rating", 1),
    "trend_daily": f"with {_VIDEOS}, t as ({_DAILY}) select upload_date, {_r('avg_views', 'avg_views')}, "
                   f"{_r('avg_rating', 'avg_rating')} from t",
    "trend_monthly": f"with {_VIDEOS} select cast(date_trunc('month', date '2008-01-01' - age) as date) as upload_month, "
                     f"{_r('avg(views)', 'avg_views')}, {_r('avg(rating)', 'avg_rating')} from videos "
                     f"where age is not null and age >= 0 group by 1",
    "trend_reaggregate": f"with {_VIDEOS}, t as ({_DAILY}) select upload_date, {_r('avg(avg_views)', 'avg_views')}, "
                         f"{_r('avg(avg_rating)', 'avg_rating')} from t where upload_date is not null "
                         f"and avg_views is not null and avg_rating is not null group by upload_date",
    "range_filter": f"with {_VIDEOS} select {_vsel()} from videos where age between 100 and 1500 "
                    f"and views between 5000 and 60000 and rating between 1.0 and 3.0",
    "counted_queries": f"with {_VIDEOS} "
                       "select 'category = ''R''' as query, count(*) filter (where category = 'R') as matched from videos "
                       "union all select 'views > 1000', count(*) filter (where views > 1000) from videos "
                       "union all select 'uploader = ''u7''', count(*) filter (where uploader = 'u7') from videos "
                       "union all select 'rating = 5.0', count(*) filter (where rating = 5.0) from videos",
    "quantile_band": f"with {_VIDEOS}, {_BAND} select {_vsel()} from band",
    "length_ranges": f"""with {_VIDEOS}, {_BAND},
  t as (select views, case {_LEN_CASE} end as length_range, case {_LEN_ORDER} end as range_order from band)
select length_range, range_order, count(*) as n, {_r('cast(min(views) as double)', 'min')},
       {_r('quantile_cont(views, 0.25)', 'q1')}, {_r('quantile_cont(views, 0.5)', 'median')},
       {_r('quantile_cont(views, 0.75)', 'q3')}, {_r('cast(max(views) as double)', 'max')}
from t where length_range is not null group by length_range, range_order""",
    "correlation_pairs": _pairs_sql(),
    "correlation_matrix": _matrix_sql(),
    "views_histogram": _HIST,
    "views_density": _DENSITY,
    "dedup_first": f"""with v as (
  select concat(l_orderkey, '-', l_linenumber) as video_id, concat('u', l_suppkey) as uploader,
         {_AGE} as age, l_returnflag as category, cast(floor(l_quantity * 75) as integer) as length,
         cast(floor(l_extendedprice) as bigint) as views, l_discount * 50 as rating,
         cast(l_partkey % 100 as integer) as comments_count,
         cast(floor(l_tax * 1000) as bigint) as ratings_count, strftime(l_shipdate, '%y%m%d') as crawl_date
  from lineitem),
  r as (select *, row_number() over (partition by video_id order by crawl_date, uploader, age, category,
                  length, views, rating, comments_count, ratings_count) as rn from v)
select video_id, uploader, age, category, length, views, {_r('rating', 'rating')}, comments_count,
       ratings_count, crawl_date from r where rn = 1""",
    "coerce_numeric": """with e as (
  select event_id, cast(event_id % 4 as integer) as kind,
         case event_id % 4 when 0 then cast(value as varchar) when 1 then props when 2 then null
              else ' ' || cast(cast(floor(value) as bigint) as varchar) || ' ' end as raw
  from events),
  d as (select event_id, kind, try_cast(raw as double) as d from e),
  c as (select event_id, kind, case when d is null or isnan(d) or isinf(d) then 0.0 else d end as v from d)
select event_id, kind, cast(trunc(v) as bigint) as views, round(v, 6) as rating from c""",
    "fill_defaults": "select d.doc_id, d.n_chars, coalesce(l.quality, 0) as quality, coalesce(l.toxic, -1) as toxic "
                     "from documents d left join labels l on d.doc_id = l.doc_id",
    "related_string": "select concat(l_orderkey, '-', l_linenumber) as video_id, "
                      "case when l_linenumber = 1 or l_linenumber = 7 then '' "
                      "else concat('p', l_partkey, ',s', l_suppkey) end as related_ids from lineitem",
    "page": f"with {_VIDEOS}, t as (select * from videos order by {', '.join(_VCOLS)} limit 100 offset 200) "
            f"select {_vsel()} from t",
    "page_deep": f"with {_VIDEOS}, t as (select * from videos order by {', '.join(_VCOLS)} limit 100 offset 45000) "
                 f"select {_vsel()} from t",
    "crawl_parse": f"""with {_LINES}
select folder, file_name, line_pos, {_CRAWL_FIELDS}, cast(len(rel) as integer) as n_related,
       array_to_string(rel, ',') as related
from status where status = 'ok'""",
    "crawl_load": f"""{_CRAWLED}
select {_CRAWL_FIELDS}, array_to_string(rel, ',') as related, crawl_date, folder, file_name, line_pos
from ranked where rn = 1""",
    "crawl_accounting": f"""{_CRAWLED},
  per_file as (select folder, file_name, count(*) as lines_read,
                      count(*) filter (where st = 'skipped') as skipped,
                      count(*) filter (where st = 'short') as short,
                      count(*) filter (where st = 'bad') as bad,
                      count(*) filter (where st = 'ok') as ok
               from dated group by folder, file_name),
  kept as (select folder, file_name, count(*) as kept from ranked where rn = 1 group by folder, file_name),
  f as (select p.*, coalesce(k.kept, 0) as kept from per_file p left join kept k using (folder, file_name))
select folder, file_name, cast(sum(lines_read) as bigint) as lines_read, cast(sum(skipped) as bigint) as skipped,
       cast(sum(short) as bigint) as short, cast(sum(bad) as bigint) as bad,
       cast(sum(ok - kept) as bigint) as duplicates, cast(sum(kept) as bigint) as kept
from f group by rollup (folder, file_name)""",
    "quantiles": f"with {_VIDEOS} select " + ", ".join(
        _r(f"quantile_cont(views, {q})", "q_" + f"{q:g}".replace(".", "_")) for q in [0.01, 0.25, 0.5, 0.75, 0.99])
        + " from videos",
    "trend_daily_valid": f"with {_VIDEOS} select date '2008-01-01' - age as upload_date, "
                         f"{_r('avg(views)', 'avg_views')}, {_r('avg(rating)', 'avg_rating')} from videos "
                         f"where age is not null and age >= 0 group by 1",
    "top_views_25": _top_sql("views", 25),
    "length_density": _LDENS,
    "related_correlation": _related_corr_sql(),
    "interactive_slice": f"with {_VIDEOS}, t as (select * from videos where age between 0 and 2000 "
                         f"and rating between 2.0 and 4.5 order by {', '.join(_VCOLS)} limit 100 offset 100) "
                         f"select {_vsel()} from t",
    "csv_roundtrip": f"with {_VIDEOS} select category, {_r('avg(views)', 'avg_views')}, "
                     f"{_r('avg(rating)', 'avg_rating')} from videos group by category",
    "json_roundtrip": f"with {_RELVIDEOS} select " + _RV_SELECT.format(age="age", length="length", cc="cast(comments_count as bigint)")
                      + " from rv",
    "parquet_roundtrip": f"with {_RELVIDEOS} select " + _RV_SELECT.format(
        age="cast(age as bigint)", length="cast(length as bigint)", cc="cast(comments_count as bigint)") + " from rv",
    "tolerant_csv": """select case when l_linenumber = 1 then 'x,' || l_orderkey else cast(l_orderkey as varchar) end as a,
       case when l_linenumber = 3 then null else cast(l_partkey as varchar) end as b
from lineitem where l_linenumber not in (2, 4)""",
    "tolerant_csv_one_column": """select count(*) as n_rows, count(*) as n_a, count(*) filter (where l_linenumber = 1) as n_commas
from lineitem where l_linenumber not in (2, 4)""",
    "chart_category_views": f"with {_VIDEOS} select category, {_r('avg(views)', 'avg_views')} from videos "
                            f"where category is not null group by category",
    "category_normalised": f"""with {_VIDEOS},
  c as (select views, rating,
               case right(video_id, 1) when '3' then ' ' || category || ' '
                                       when '4' then category || ' &amp; x'
                                       when '5' then category || ' & x'
                                       else category end as raw from videos)
select replace(trim(raw), '&amp;', '&') as category, {_r('avg(views)', 'avg_views')},
       {_r('avg(rating)', 'avg_rating')} from c group by 1""",
    "chart_category_views_asc": f"with {_VIDEOS} select category, {_r('avg(views)', 'avg_views')} from videos "
                                f"group by category",
    "chart_category_ratings": f"with {_VIDEOS} select category, {_r('avg(rating)', 'avg_rating')} from videos "
                              f"where category is not null group by category",
    "chart_top_videos": f"with {_VIDEOS} select video_id, views from videos order by views desc nulls last, "
                        f"video_id, uploader, age, category, length, rating, comments_count limit 10",
    "metric_export": f"""with {_VIDEOS},
  tr as (select * from videos order by rating desc nulls last, video_id, uploader, age, category, length, views,
         comments_count limit 1),
  mw as (select * from videos order by views desc nulls last, video_id, uploader, age, category, length, rating,
         comments_count limit 1)
select 'Total Videos' as metric, cast(count(*) as varchar) as value from videos
union all select 'Average Views', printf('%.6f', avg(views)) from videos
union all select 'Median Views', printf('%.6f', median(views)) from videos
union all select 'Top Rated Video', cast(to_json({{'video_id': video_id, 'uploader': uploader, 'age': age,
  'category': category, 'length': length, 'views': views, 'rating': rating, 'comments_count': comments_count}}) as varchar) from tr
union all select 'Most Watched Video', cast(to_json({{'video_id': video_id, 'uploader': uploader, 'age': age,
  'category': category, 'length': length, 'views': views, 'rating': rating, 'comments_count': comments_count}}) as varchar) from mw""",
}


_DIRTY = _VIDEOS.replace("videos as (", "base as (", 1) + """, videos as (
  select video_id, uploader, age, case when comments_count % 7 != 0 then category end as category,
         case when comments_count % 5 = 0 then length % 61 else length end as length,
         case when comments_count % 11 = 0 then 0 else views end as views,
         case when comments_count % 13 = 0 then 'nan'::double else rating end as rating, comments_count
  from base)"""
_KNOWN_RATING = "avg(case when isnan(rating) then null else rating end)"
_DIRTY_CATEGORY = f"with {_DIRTY} select category, {_r('avg(views)', 'avg_views')}, {_r(_KNOWN_RATING, 'avg_rating')} from videos"
ORACLE |= {
    "top_views_500": _top_sql("views", 500),
    "page_sorted": ORACLE["page"] + " order by views desc",
    "range_reversed_pair": f"with {_VIDEOS} select {_vsel()} from videos where age between 1500 and 100",
    "range_fractional_pair": f"with {_VIDEOS} select {_vsel()} from videos where views between 20000.5 and 30000.5",
    "preview": f"with {_VIDEOS}, t as (select * from videos order by {', '.join(_VCOLS)} limit {S.PREVIEW_ROWS}) select {_vsel()} from t",
    # the file tree: one folder without a log, one whose log has no date
    "crawl_load_files": ORACLE["crawl_load"].replace("folder = 'c1998'", "folder in ('c1997', 'c1998')").replace(", line_pos\nfrom", "\nfrom"),
    "crawl_accounting_files": ORACLE["crawl_accounting"].replace("folder = 'c1998'", "folder in ('c1997', 'c1998')"),
    "length_chart": f"""with box as ({ORACLE["length_ranges"]}), curve as ({_LDENS})
select box.*, peak_point, peak_x from box left join
  (select length_range, min(point) as peak_point, min(x) as peak_x from curve where density = 1 group by 1) using (length_range)""",
    "page_indexed": f"""with {_VIDEOS}, t as (select * from videos order by category, {', '.join(c for c in _VCOLS if c != 'category')}
  limit 70 offset 910) select {_vsel()} from t""",
    "report_statistics": ORACLE["metric_export"],
    "report_top": ORACLE["top_views"],
    "report_trends": ORACLE["trend_reaggregate"],
    "report_category_stats": ORACLE["category_stats"],
    "report_related": ORACLE["related_string"],
    "report_chart_views": ORACLE["chart_category_views"],
    "report_chart_ratings": ORACLE["chart_category_ratings"],
    "report_chart_months": ORACLE["trend_monthly"],
    "report_chart_days": ORACLE["trend_reaggregate"],
    "report_chart_top": ORACLE["chart_top_videos"],
    "report_chart_correlations": ORACLE["correlation_pairs"],
    "report_chart_histogram": ORACLE["views_histogram"],
    "report_chart_density": ORACLE["views_density"],
    "report_chart_lengths": ORACLE["length_ranges"],
    "report_chart_shapes": ORACLE["length_density"],
    "sink_modes": f"with {_VIDEOS} select count(distinct category) as n_rows, true as refused from videos",
    "csv_reversible": "select doc_id, case when doc_id % 7 != 0 then case when doc_id % 5 != 0 then text else '' end end as text from documents",
    "published_parts": f"with {_VIDEOS} select video_id, views, category from videos",
    "page_first_key_null": f"""with {_DIRTY}, t as (select * from videos
  order by category nulls last, rating nulls last, {', '.join(c for c in _VCOLS if c not in ('category', 'rating'))} limit 50 offset 22500)
select {_vsel()} from t""",
    "trend_of_text": f"""with {_VIDEOS} select date '2008-01-01' - age as upload_date, {_r('avg(views)', 'avg_views')},
       {_r('avg(rating)', 'avg_rating')} from videos
where age >= 0 and comments_count % 7 != 0 and rating is not null group by 1""",
    "published_file": ORACLE["category_stats"],
    "projected_scan": f"with {_VIDEOS} select " + ", ".join(
        _r("rating", "rating") if c == "rating" else c for c in S.ANALYSIS_COLUMNS) + " from videos",
    "drop_related": "with " + _VIDEOS.replace("as comments_count", "as comments_count, cast(floor(l_tax * 1000) as bigint) as ratings_count, "
                                                                 "strftime(l_shipdate, '%y%m%d') as crawl_date")
                    + f" select {_vsel()}, ratings_count, crawl_date from videos",
    "dirty_category_stats": f"{_DIRTY_CATEGORY} where category is not null group by category",
    "dirty_category_null": f"{_DIRTY_CATEGORY} group by category",
    "dirty_top_rating": f"""with {_DIRTY}, t as (select * from videos
  order by case when isnan(rating) then null else rating end desc nulls last, {', '.join(c for c in _VCOLS if c != 'rating')} limit 200)
select {_vsel()} from t""",
    "dirty_length_ranges": ORACLE["length_ranges"].replace(_VIDEOS, _DIRTY),
    "dirty_histogram": ORACLE["views_histogram"].replace(_VIDEOS, _DIRTY),
    "dirty_density": ORACLE["views_density"].replace(_VIDEOS, _DIRTY),
    "dirty_daily_trend": f"""with {_DIRTY} select date '2008-01-01' - age as upload_date, {_r('avg(views)', 'avg_views')},
       {_r(_KNOWN_RATING, 'avg_rating')} from videos group by 1""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each key of ``queries()`` (same column names)."""
    return {k: v for k, v in ORACLE.items() if k in QUERIES} | _llm_oracle()
