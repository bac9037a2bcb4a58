"""Compositions: report, chart datasets, interactive slice, prepare."""

import os

from pyspark.sql import functions as F

from paths import SF001
from vidlens.plans import adapter, charts, jobs


def test_report_writes_every_result(spark, tmp_dir):
    v = adapter.videos(spark, SF001, related=True)
    res = jobs.report(v, os.path.join(tmp_dir, "out"), top_n="7", parts=("statistics", "top", "categories",
                                                                         "trends", "related"))
    names = set(os.listdir(os.path.join(tmp_dir, "out")))
    assert {"statistics", "top_7_views", "top_7_ratings", "top_7_comments", "category_stats", "trends",
            "related_analysis"} <= names
    assert res["top_7_views"].count() == 7
    stats = dict(map(tuple, res["statistics"].collect()))
    assert list(stats) == ["Total Videos", "Average Views", "Median Views", "Top Rated Video", "Most Watched Video"]


def test_chart_datasets(spark):
    v = adapter.videos(spark, SF001)
    ds = jobs.chart_datasets(v)
    assert set(ds) >= {"category_views", "category_ratings", "monthly_trend", "daily_trend", "top_videos",
                       "correlation_table", "views_histogram", "views_density", "length_summary",
                       "length_density"}
    cv = [r["avg_views"] for r in ds["category_views"].collect()]
    assert cv == sorted(cv, reverse=True)
    cr = [r["category"] for r in ds["category_ratings"].collect()]
    assert cr == [r["category"] for r in ds["category_views"].collect()]
    assert ds["top_videos"].columns == ["video_id", "views"]
    asc = [r["avg_views"] for r in charts.category_views(v, order="asc").collect()]
    assert asc == sorted(asc)


def test_interactive_slice_and_page_info(spark):
    v = adapter.videos(spark, SF001)
    info = jobs.page_info(v.where("age between 0 and 500"))
    rows = jobs.interactive_slice(v, {"age": "500-0"}, 0, sort_col="views", ascending=False).collect()
    assert len(rows) == min(100, info["rows"])
    assert [r["views"] for r in rows] == sorted((r["views"] for r in rows), reverse=True)


def test_prepare_cleans_and_stores(spark, tmp_dir):
    df = spark.createDataFrame([("a", None, "x", None, None, 3.5, ["r"]), ("b", "12", None, "7.9", "bad", None, None)],
                               "video_id string, views string, category string, length string, age string, "
                               "rating double, related_ids array<string>")
    stored = jobs.prepare(df, os.path.join(tmp_dir, "pq"))
    got = {r["video_id"]: r for r in stored.collect()}
    assert (got["a"]["views"], got["a"]["length"], got["a"]["age"], got["a"]["rating"]) == (0, 0, -1, 3.5)
    assert (got["b"]["views"], got["b"]["length"], got["b"]["age"], got["b"]["rating"]) == (12, 7, -1, 0.0)
    assert got["a"]["related_ids"] == ["r"]


def test_normalised_categories(spark):
    from vidlens.operators import stats
    df = spark.createDataFrame([("News &amp; Politics", 1), ("News & Politics", 3), (" UNA ", 5), ("UNA", 7)],
                               "category string, views long").withColumn("rating", F.lit(1.0))
    raw = stats.category_stats(df).count()
    norm = {r["category"]: r["avg_views"] for r in stats.category_stats(df, normalise=True).collect()}
    assert raw == 4 and norm == {"News & Politics": 2.0, "UNA": 6.0}


def test_density_in_histogram_units(spark):
    import numpy as np
    v = adapter.videos(spark, SF001)
    d = charts.views_distribution(v)
    h = d["histogram"].toPandas().sort_values("bin")
    c = d["density"].toPandas().sort_values("point")
    width = np.log10(h["bin_hi"].iloc[0]) - np.log10(h["bin_lo"].iloc[0])
    # the scaled curve integrates (over log10 units) to about n * bin width
    area = np.trapezoid(c["count_density"], c["log_x"])
    assert abs(area / (h["count"].sum() * width) - 1) < 0.1


def test_trends_roundtrip_through_csv(spark, tmp_dir):
    v = adapter.videos(spark, SF001)
    res = jobs.report(v, os.path.join(tmp_dir, "r"), parts=("trends",))
    back = jobs.trends_from_csv(spark, os.path.join(tmp_dir, "r", "trends")).collect()
    want = res["trends"].collect()
    assert [str(r["upload_date"]) for r in back] == [str(r["upload_date"]) for r in want]
    assert all(abs(a["avg_views"] - b["avg_views"]) < 1e-9 for a, b in zip(back, want))


def _rows(df):
    return [tuple(None if x is None else round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()]


def _odd_videos(spark):
    """Ties, nulls, NaN, repeated rows, lengths beyond the window and missing ages."""
    nan = float("nan")
    rows = [(f"v{i % 70:03d}", f"u{i % 5}", None if i % 11 == 0 else i % 40 - 1, None if i % 13 == 0 else f"c{i % 4}",
             None if i % 17 == 0 else (i * 37) % 4000, None if i % 19 == 0 else (i % 23) ** 3,
             nan if i % 29 == 0 else None if i % 31 == 0 else float(i % 3 + 3), i, None if i % 37 == 0 else i % 6)
            for i in range(300)]
    rows += rows[:40]
    return spark.createDataFrame(rows, "video_id string, uploader string, age int, category string, length int, "
                                       "views long, rating double, ratings_count long, comments_count long")


def test_fused_report_equals_the_single_results(spark, tmp_dir):
    odd, small = _odd_videos(spark), ("statistics", "top", "categories", "trends")
    for name, v, n, parts in (("odd", odd, 60, jobs.PARTS), ("few", odd.limit(3), 10, small),
                              ("none", odd.limit(0), 10, small)):
        want, got = jobs.report(v, None, n, parts), jobs.report(v, os.path.join(tmp_dir, name), n, parts)
        assert set(got) == set(want)
        for k in want:
            assert got[k].columns == want[k].columns, (name, k)
            a, b = _rows(want[k]), _rows(got[k])
            if k in ("category_stats", "chart_views_histogram", "chart_views_density", "chart_length_density"):
                a, b = sorted(a, key=str), sorted(b, key=str)
            assert str(a) == str(b), (name, k)


def test_report_scans_the_table_four_times(spark, tmp_dir):
    v = adapter.videos(spark, SF001, related=True)
    seen, n = spark.sparkContext.accumulator(0), v.count()

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    jobs.report(v.mapInPandas(count, v.schema), os.path.join(tmp_dir, "scans"))
    assert n < seen.value <= 4 * n


def test_report_refuses_unknown_parts(spark):
    import pytest
    with pytest.raises(ValueError):
        jobs.report(adapter.videos(spark, SF001), parts=("statistics", "tops"))
