"""Operators against pandas (the reference's own semantics) on small frames."""

import math
import os
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vidlens import schema as S
from vidlens.functions import columns as C
from vidlens.operators import clean, distribution, filters, quantiles, stats, topn, trends


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(0, 50, 500), np.full(300, 7), rng.normal(100, 30, 200).round()])
    df = spark.createDataFrame(pd.DataFrame({"g": rng.integers(0, 3, len(vals)), "x": vals.astype(float)}))
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles.exact_quantiles(df, "x", probs, partitions=5).collect()[0]
    want = pd.Series(vals).quantile(probs).tolist()
    assert np.allclose(list(got), want)
    pdf = df.toPandas()
    grouped = {r["g"]: list(r)[1:] for r in quantiles.exact_quantiles(df, "x", probs, by=["g"], partitions=4).collect()}
    for g, sub in pdf.groupby("g"):
        assert np.allclose(grouped[g], sub["x"].quantile(probs).tolist())


def test_quantile_methods_agree(spark):
    df = spark.range(1001).withColumn("x", (F.col("id") * 7919 % 1001).cast("double"))
    a = quantiles.exact_quantiles(df, "x", [0.5, 0.9]).collect()[0]
    b = quantiles.exact_quantiles(df, "x", [0.5, 0.9], method="builtin").collect()[0]
    assert list(a) == list(b)


def test_single_value_and_empty(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    assert quantiles.exact_quantiles(one, "x", [0.5]).collect()[0][0] == 5.0
    empty = spark.createDataFrame([], "x double")
    assert quantiles.exact_quantiles(empty, "x", [0.5]).collect() == []


def test_coerce_numeric_like_pandas(spark):
    raw = [None, "", "abc", "12.7", " 12 ", "1e3", "nan", "inf", "-3.9", "7"]
    df = spark.createDataFrame([(r,) for r in raw], "views string")
    got = [r[0] for r in clean.coerce_numeric(df, {"views": 0}, ["views"]).collect()]
    s = pd.to_numeric(pd.Series(raw, dtype=object), errors="coerce")
    s = s.replace([np.inf, -np.inf], np.nan).fillna(0).astype(int)
    assert got == s.tolist()


def test_fill_defaults_leaves_strings(spark):
    df = spark.createDataFrame([(None, None, None)], "views long, age int, category string")
    r = clean.fill_defaults(df).collect()[0]
    assert (r["views"], r["age"], r["category"]) == (0, -1, None)


def test_length_range_right_closed(spark):
    lengths = [0, 1, 60, 61, 300, 600, 1200, 1800, 3599, 3600, 3601]
    df = spark.createDataFrame([(x,) for x in lengths], "length int")
    got = [r[0] for r in df.select(C.length_range("length")).collect()]
    want = pd.cut(pd.Series(lengths), bins=S.LENGTH_EDGES, labels=S.LENGTH_LABELS)
    assert got == [None if pd.isna(w) else str(w) for w in want]


def test_range_filter_inclusive_and_text(spark):
    df = spark.createDataFrame([(a, a * 10, a / 2) for a in range(10)], "age int, views long, rating double")
    assert filters.range_filter(df, {"age": "7-3"}).count() == 5
    assert filters.filter_videos(df, age_range=(2, 4), views_range=(0, 30), rating_range=(0, 5)).count() == 2
    assert filters.range_filter(df, {"age": ""}).count() == 10
    assert filters.range_filter(df, {}).count() == 10
    with pytest.raises(ValueError):
        filters.range_filter(df, {"age": "1-2-3"})


def test_validate_n_and_paging():
    assert topn.validate_n("abc") == 10 and topn.validate_n(0) == 10 and topn.validate_n(101) == 10
    assert topn.validate_n("25") == 25
    assert topn.page_count(250) == 3 and topn.next_page(2, 3) == 2 and topn.prev_page(0) == 0


def test_pages_disjoint_and_cover(spark):
    df = spark.range(250).select(F.format_string("v%03d", "id").alias("video_id"), F.col("id").alias("views"))
    seen = []
    for p in range(3):
        seen += [r["video_id"] for r in topn.page(df, p, 100).collect()]
    assert seen == sorted(seen) and len(set(seen)) == 250


def test_top_n_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "video_id string, views long")
    assert [r[0] for r in topn.top_views(df, 3).collect()] == ["c", "a", "b"]


def test_summary_and_arg_max(spark):
    pdf = pd.DataFrame({"video_id": list("abcdef"), "views": [5, 1, 9, 9, 2, 4],
                        "rating": [1.0, 5.0, 3.0, 5.0, 0.0, 2.0]})
    df = spark.createDataFrame(pdf)
    r = stats.summary_statistics(df).collect()[0]
    assert r["total_videos"] == 6 and r["average_views"] == pdf.views.mean()
    assert r["median_views"] == pdf.views.median()
    assert stats.top_rated(df).collect()[0]["video_id"] == "b"
    assert stats.most_watched(df).collect()[0]["video_id"] == "c"


def test_correlation_pairs_like_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"views": rng.integers(0, 1000, 200), "rating": rng.random(200) * 5,
                        "comments_count": rng.integers(0, 50, 200), "length": np.full(200, 60)})
    pdf.loc[::7, "rating"] = np.nan
    got = stats.correlation_pairs(spark.createDataFrame(pdf)).toPandas()
    want = {}
    for x, y in combinations(S.CORRELATION_COLUMNS, 2):
        both = pdf[[x, y]].dropna()
        if both[x].nunique() > 1 and both[y].nunique() > 1:
            want[x, y] = np.corrcoef(both[x], both[y])[0, 1]
    assert len(want) == 3                      # the constant column has no correlation
    assert {(f, g) for f, g in zip(got["Feature 1"], got["Feature 2"])} == set(want)
    for f, g, r in zip(got["Feature 1"], got["Feature 2"], got["Correlation"]):
        assert math.isclose(r, want[f, g], rel_tol=1e-9)
    assert list(got["Absolute Correlation"]) == sorted(got["Absolute Correlation"], reverse=True)


def test_correlations_of_large_means_and_gaps(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, 4000)
    pdf = pd.DataFrame({"a": 1e9 + x, "b": -1e7 + 0.5 * x + rng.normal(0, 1, 4000), "c": np.sort(x) * 1e6, "d": rng.random(4000)})
    pdf.loc[::3, "a"] = np.nan
    pdf.loc[1::5, "b"] = None
    pdf["e"] = 7.25
    pdf["f"] = np.nan
    df = spark.createDataFrame(pdf, "a double, b double, c double, d double, e double, f double").repartition(5)
    got = {(r.x, r.y): r.r for r in stats.correlation_matrix(df).collect()}
    def exact(x, y):
        if x == y:
            return 1.0
        both = pdf[[x, y]].dropna().astype(np.longdouble)
        u, v = both[x] - both[x].mean(), both[y] - both[y].mean()
        return float((u * v).sum() / np.sqrt((u * u).sum() * (v * v).sum()))
    assert len(got) == 36
    for (x, y), r in got.items():
        if "e" in (x, y) or "f" in (x, y):
            assert r is None
        else:
            assert math.isclose(r, exact(x, y), rel_tol=1e-6, abs_tol=1e-9)
    # no row is repeated for a pair: the aggregate reads the rows themselves
    plan = df._sc._jvm.PythonSQLUtils.explainString(stats.correlation_pairs(df, ["a", "b", "c"])._jdf.queryExecution(), "formatted")
    assert plan.index("Generate") < plan.index("HashAggregate")


def test_pages_and_index_in_any_order(spark, tmp_dir):
    rng = np.random.default_rng(8)
    rows = [(int(i), None if i % 9 == 0 else "xyz"[i % 3], float("nan") if i % 11 == 0 else int(rng.integers(0, 4)) * -0.5)
            for i in rng.permutation(700)] + [(5, "x", 1.0)] * 40
    df = spark.createDataFrame(rows, "video_id int, category string, rating double").repartition(4)
    def key(r):
        return [(v is None, (v != v, 0 if v != v else v) if isinstance(v, float) else v if v is not None else 0)
                for v in (r[1], r[0], r[2])]
    want = sorted(rows, key=key)
    def same(a, b):
        assert [tuple(map(str, r)) for r in a] == [tuple(map(str, r)) for r in b]
    shallow = topn.SHALLOW_ROWS
    index = topn.PageIndex.build(df, os.path.join(tmp_dir, "index"), ["category"], stride=64, partitions=5)
    assert index.rows() == 740
    try:
        topn.SHALLOW_ROWS = 0
        for number, size in ((0, 50), (3, 64), (9, 77), (14, 50), (15, 50), (99, 50), (0, 1000)):
            page = want[number * size:(number + 1) * size]
            same(index.page(df, number, size).collect(), page)
            same(topn.page(df, number, size, order_by=["category"], partitions=5).collect(), page)
        same(topn.page(df, 1, 50, order_by=["category"], sort_col="video_id").select("video_id").collect(),
             [(v,) for v in sorted(r[0] for r in want[50:100])])
    finally:
        topn.SHALLOW_ROWS = shallow
    empty = topn.PageIndex.build(df.limit(0), os.path.join(tmp_dir, "none"), ["category"])
    assert empty.rows() == 0 and empty.page(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        index.page(df, -1)


def test_building_a_page_runs_nothing(spark):
    df = spark.range(100_000).select(F.col("id").alias("video_id"), (F.col("id") % 7).alias("views"))
    group = "no-job-here"
    spark.sparkContext.setJobGroup(group, "pages")
    try:
        topn.page(df, 700, 100), topn.page(df, 2, 100)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(group) in ((), [])
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_histogram_counts_and_band_subset(spark):
    rng = np.random.default_rng(5)
    views = np.concatenate([rng.integers(1, 10**6, 500), [0, 0]])
    df = spark.createDataFrame(pd.DataFrame({"views": views, "length": rng.integers(0, 4000, len(views))}))
    h = distribution.log_histogram(df).toPandas()
    assert len(h) == 50 and h["count"].sum() == (views > 0).sum()
    cnt, _ = np.histogram(np.log10(views[views > 0]), bins=50)
    assert h.sort_values("bin")["count"].tolist() == cnt.tolist()
    w = filters.length_window(df)
    band = filters.quantile_band(w)
    assert band.subtract(w).count() == 0
    lo, hi = w.toPandas()["views"].quantile([0.01, 0.99])
    assert band.count() == ((w.toPandas()["views"] >= lo) & (w.toPandas()["views"] <= hi)).sum()


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(11)
    df = spark.createDataFrame(pd.DataFrame({"views": rng.lognormal(8, 1.5, 3000).astype(int) + 1}))
    d = distribution.log_density(df).toPandas().sort_values("point")
    area = np.trapezoid(d["density"], d["log_x"])
    assert 0.9 < area <= 1.01
    lv = np.log10(df.toPandas()["views"])
    h = lv.std(ddof=1) * len(lv) ** (-0.2)
    x = d["log_x"].to_numpy()
    exact = np.exp(-0.5 * ((x[:, None] - lv.to_numpy()[None, :]) / h) ** 2).sum(1) / (len(lv) * h * np.sqrt(2 * np.pi))
    assert np.allclose(d["density"], exact, atol=2e-3)


def _whole_sum(x, grid, h):
    return np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))


@pytest.mark.parametrize("tolerance", [1e-2, 1e-4, 1e-8])
def test_density_stays_within_its_bound(spark, tolerance):
    """Also where the data leave a gap, hold one value in a third of all rows, or lie far from zero."""
    rng = np.random.default_rng(3)
    cases = [np.concatenate([rng.normal(0, 1, 400), rng.normal(500, 3, 200), np.full(300, 2.0)]),
             1e9 + rng.integers(0, 50, 700).astype(float), np.array([1.0, 2.0])]
    for x in cases:
        df = spark.createDataFrame(pd.DataFrame({"views": x})).repartition(5)
        got = distribution.kde(df, points=60, tolerance=tolerance, log=False, cut=1.0).toPandas().sort_values("point")
        h = x.std(ddof=1) * len(x) ** -0.2
        assert got["point"].tolist() == list(range(60))
        assert np.allclose(got["x"], np.linspace(x.min() - h, x.max() + h, 60))
        off = np.abs(got["density"].to_numpy() - _whole_sum(x, got["x"].to_numpy(), h)).max()
        # the rest is the rounding of places far from zero
        assert off <= (tolerance + 1e-10 + 4e-16 * np.abs(x).max() / h) / (h * np.sqrt(2 * np.pi))


def test_length_directory(spark, tmp_dir):
    """Lazy and stored directories agree with pandas; nulls, NaN, ties, empty tables and extra columns."""
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"views": rng.integers(0, 400, 3000).astype(float), "length": rng.integers(-5, 3700, 3000)})
    pdf.loc[:999, "views"] = 7.0                      # a third of all rows
    pdf.loc[5:60, "views"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("views", F.when(F.col("views") != 399, F.col("views"))) \
        .withColumn("part", F.lit("x")).withColumn("n", F.lit(-1)).withColumn("value", F.lit(0))
    known = pdf[pdf["views"].notna() & (pdf["views"] != 399)]
    w = known[(known["length"] > 0) & (known["length"] < 3600)]
    lo, hi = w["views"].quantile([0.01, 0.99])
    w = w[w["views"].between(lo, hi)].copy()
    w["r"] = pd.cut(w["length"], bins=S.LENGTH_EDGES, labels=S.LENGTH_LABELS)
    want = w.groupby("r", observed=True)["views"].describe()
    stored = distribution.LengthDirectory.build(df, tmp_dir + "/counts", partitions=5)
    for d in (distribution.LengthDirectory.of(df), stored):
        got = d.summary().collect()
        assert [r["length_range"] for r in got] == list(want.index)
        assert np.allclose([[r[c] for c in ("n", "min", "q1", "median", "q3", "max")] for r in got],
                           want[["count", "min", "25%", "50%", "75%", "max"]])
        curves = d.density().toPandas()
        for lab, g in w.groupby("r", observed=True):
            x, mine = g["views"].to_numpy(float), curves[curves["length_range"] == lab].sort_values("point")
            dens = _whole_sum(x, mine["x"].to_numpy(), x.std(ddof=1) * len(x) ** -0.2)
            assert np.allclose(mine["density"], dens / dens.max(), atol=1e-6)
    rows = stored.rows.groupBy("range_order", "value").count()
    assert rows.where("count > 1").isEmpty() and stored.rows.where("value = 7").agg(F.max("part") - F.min("part")).first()[0] <= 1
    again = distribution.LengthDirectory.build(df.limit(0), tmp_dir + "/counts")
    assert again.summary().collect() == [] and again.density().collect() == []
    flat = distribution.LengthDirectory.of(spark.createDataFrame([(5, 30)] * 4, "views long, length int"))
    assert [tuple(r) for r in flat.summary().collect()] == [("0-1 min", 0, 4, 5.0, 5.0, 5.0, 5.0, 5.0)]
    assert flat.density().collect() == []             # no bandwidth, no curve


def test_trends(spark):
    df = spark.createDataFrame([(0, 10, 1.0), (0, 20, 3.0), (31, 5, 2.0), (-1, 7, 4.0)],
                               "age int, views long, rating double")
    daily = {str(r["upload_date"]): r["avg_views"] for r in trends.daily_trend(df).collect()}
    assert daily == {"2008-01-01": 15.0, "2007-12-01": 5.0, "2008-01-02": 7.0}
    monthly = [(str(r[0]), r[1]) for r in trends.monthly_trend(df).collect()]
    assert monthly == [("2007-12-01", 5.0), ("2008-01-01", 15.0)]


def test_counted_queries(spark):
    df = spark.createDataFrame([("Comedy", 2000, "PIEGUYRULZ", 5.0), ("Music", 10, "x", 4.0)],
                               "category string, views long, uploader string, rating double")
    got = {r["query"]: r["matched"] for r in filters.count_matches(df).collect()}
    assert list(got.values()) == [1, 1, 1, 1]


def test_dedup_first_skewed_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("video_id"),
                                  (F.lit(5000) - F.col("id")).alias("crawl_date"), F.col("id").alias("views"))
    out = clean.dedup_first(df, order=["crawl_date"])
    assert out.count() == 2001
    assert out.where("video_id = 'hot'").collect()[0]["views"] == 999


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=120),
       st.lists(st.floats(0, 1), min_size=1, max_size=4), st.integers(1, 9))
def test_exact_quantiles_property(spark, values, probs, parts):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = list(quantiles.exact_quantiles(df, "x", probs, partitions=parts).collect()[0])
    want = pd.Series(values, dtype=float).quantile(probs).tolist()
    assert np.allclose(got, want)


def test_parse_range_like_filter_box():
    assert C.parse_range(" 10 - 5 ", int) == (5, 10)
    assert C.parse_range("", int) is None
    for bad in ["5", "1-2-3", "-5-10", "a-b"]:
        with pytest.raises(ValueError):
            C.parse_range(bad, int)
    assert C.parse_range("4.5-2", float) == (2.0, 4.5)


def test_summary_with_nulls_and_empty(spark):
    pdf = pd.DataFrame({"views": [5.0, None, 9.0, float("nan"), 1.0, 9.0]})
    df = spark.createDataFrame([(None if v is None or (isinstance(v, float) and math.isnan(v)) else int(v),)
                                for v in pdf["views"]], "views long")
    r = stats.summary_statistics(df).collect()[0]
    assert r["total_videos"] == 6
    assert r["average_views"] == pdf["views"].mean() and r["median_views"] == pdf["views"].median()
    empty = spark.createDataFrame([], "views long")
    assert list(stats.summary_statistics(empty).collect()[0]) == [0, None, None]
    b = stats.summary_statistics(df, method="builtin").collect()[0]
    assert list(b) == list(r)


def test_quantile_stats_all_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "g string, x double")
    got = {r["g"]: r for r in quantiles.exact_quantiles(df, "x", [0.5], by=["g"], stats=True).collect()}
    assert (got["a"]["q_0_5"], got["a"]["rows"], got["a"]["count"], got["a"]["min"], got["a"]["max"],
            got["a"]["sum"]) == (2.0, 2, 2, 1.0, 3.0, 4.0)
    assert (got["b"]["q_0_5"], got["b"]["rows"], got["b"]["count"]) == (None, 1, 0)


def test_length_summary_methods_agree(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame(pd.DataFrame({"views": rng.integers(1, 10**5, 800),
                                             "length": rng.integers(0, 4000, 800)}))
    a = distribution.length_range_summary(df).collect()
    b = distribution.length_range_summary(df, method="builtin").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_violin_curves_match_exact_kde(spark):
    rng = np.random.default_rng(21)
    pdf = pd.DataFrame({"views": rng.integers(100, 20000, 1500), "length": rng.integers(1, 3599, 1500)})
    got = distribution.length_range_density(spark.createDataFrame(pdf)).toPandas()
    w = pdf[(pdf["length"] > 0) & (pdf["length"] < 3600)]
    lo, hi = w["views"].quantile([0.01, 0.99])
    w = w[(w["views"] >= lo) & (w["views"] <= hi)].copy()
    w["r"] = pd.cut(w["length"], bins=S.LENGTH_EDGES, labels=S.LENGTH_LABELS)
    for lab, g in w.groupby("r", observed=True):
        x = g["views"].to_numpy(float)
        h = x.std(ddof=1) * len(x) ** (-0.2)
        grid = np.linspace(x.min() - 2 * h, x.max() + 2 * h, 100)
        dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1)
        dens = dens / dens.max()
        mine = got[got["length_range"] == lab].sort_values("point")
        assert np.allclose(mine["x"], grid)
        assert np.allclose(mine["density"], dens, atol=5e-3)


def test_pages_cut_the_sorted_table(spark):
    rng = np.random.default_rng(4)
    rows = [(f"v{i % 700:04d}" if i % 50 else None, int(rng.integers(0, 50)), float(rng.integers(0, 3)) / 2, {"k": i})
            for i in range(2000)]
    df = spark.createDataFrame(rows, "video_id string, views int, rating double, extra map<string,int>")
    order = sorted(((r[0] is None, r[0] or "", r[1], r[2]) for r in rows))
    for number in (0, 3, 7, 19, 21, 22, 25):
        for partitions in (None, 7):
            got = [(r[0] is None, r[0] or "", r[1], r[2]) for r in topn.page(df, number, 90, partitions=partitions).collect()]
            assert got == order[number * 90:number * 90 + 90]
    assert topn.page(df.limit(0), 0).collect() == []


def test_reported_faults_stay_mended(spark):
    df = spark.createDataFrame([("a", 0, float("nan")), ("b", 5, 4.0), ("c", 29, 1.0), ("d", 40, None)] +
                               [(f"x{i}", 100, 2.0) for i in range(150)], "video_id string, views long, rating double")
    assert topn.top_views(df, 120).count() == 120 and topn.top_views(df, "120").count() == 10
    with pytest.raises(ValueError):
        topn.top_views(df, 0)
    assert topn.top_rating(df, 1).first()["video_id"] == "b" and stats.top_rated(df).first()["video_id"] == "b"
    got = stats.category_stats(df.selectExpr("'k' as category", "views", "rating")).first()
    assert math.isclose(got["avg_rating"], (4 + 1 + 2 * 150) / 152)
    assert sorted(r[0] for r in filters.range_filter(df, {"views": (0.5, 29)}).collect()) == ["b", "c"]
    assert filters.range_filter(df, {"views": (4, 2)}).count() == 0
    odd = spark.createDataFrame([(t,) for t in ["1e30", "1.5d", "7f", "0x1p3", " 12.7 ", "-3", ".5", "5.", "1e3", "nan", ""]], "v string")
    assert [r[0] for r in odd.select(C.to_number("v", 9)).collect()] == [9, 9, 9, 9, 12, -3, 0, 5, 1000, 9, 9]
    assert spark.range(1).select(C.upload_date(F.lit(10 ** 12))).first()[0] is None


def test_density_of_constant_data(spark):
    rows = [("flat", 7)] * 5 + [("one", 3)] + [("real", v) for v in (1, 5, 9, 30)]
    df = spark.createDataFrame(rows, "g string, views long")
    assert {r["g"] for r in distribution.kde(df, by="g", log=False).collect()} == {"real"}
    assert distribution.log_density(df.where("g = 'flat'")).collect() == []


def test_sorts_and_trend_reaggregation(spark):
    df = spark.createDataFrame([("b", 3.0), ("a", 3.0), ("c", 1.0)], "category string, avg_views double")
    assert [r[0] for r in topn.sort_by(df, "avg_views").collect()] == ["c", "a", "b"]
    assert [r[0] for r in topn.sort_by(df, "avg_views", ascending=False).collect()] == ["a", "b", "c"]
    t = spark.createDataFrame([("2008-01-02", 1.0, 2.0), ("2008-01-01", 3.0, None), ("2008-01-02", 3.0, 4.0),
                               (None, 5.0, 5.0)], "upload_date string, avg_views double, avg_rating double")
    got = [(str(r[0]), r[1], r[2]) for r in trends.reaggregate_trend(t).collect()]
    assert got == [("2008-01-02", 2.0, 3.0)]     # incomplete rows dropped, one row per date
