"""Physical-plan properties that matter at scale (read from ``explain``)."""

import pytest
from pandas.testing import assert_frame_equal

import __spark_entry__ as E
from paths import SF001
from vidlens.operators import filters, stats, topn
from vidlens.plans import adapter


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = formatted(E.QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_range_filter_pushed_to_scan(spark):
    li = adapter.table(spark, SF001, "lineitem").withColumnRenamed("l_quantity", "age")
    p = formatted(filters.range_filter(li, {"age": "10-20"}).select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(age), GreaterThanOrEqual(age,10.0), LessThanOrEqual(age,20.0)]" in p \
        or ("GreaterThanOrEqual" in p and "LessThanOrEqual" in p)
    # only the needed columns are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_category_stats_partial_aggregation_and_pruning(spark):
    p = formatted(stats.category_stats(adapter.videos(spark, SF001)))
    assert "partial_avg" in p
    assert "ReadSchema: struct<l_extendedprice:double,l_discount:double,l_returnflag:string>" in p


def test_top_n_is_take_ordered(spark):
    p = formatted(topn.top_views(adapter.videos(spark, SF001), 10))
    assert "TakeOrderedAndProject" in p


def test_dedup_aggregates_map_side(spark):
    p = formatted(E.queries()["dedup_first"](spark, SF001))
    assert "partial_min" in p and "Window" not in p


def test_plan_summary(spark):
    from vidlens.plans.inspect import plan_summary
    s = plan_summary(stats.category_stats(adapter.videos(spark, SF001)), execute=True)
    assert s["aggregates"].get("HashAggregate", 0) >= 2 and s["joins"] == {}
    assert s["scans"] == ["struct<l_extendedprice:double,l_discount:double,l_returnflag:string>"]


def test_plan_summary_follows_the_main_plan(spark):
    from vidlens.plans.inspect import plan_summary
    df = spark.range(100).where("id > (select avg(id) from range(10))").selectExpr("id % 7 as k", "id")
    s = plan_summary(df.groupBy("k").count().orderBy("k"), execute=True)
    assert s["exchanges"] == {"hash": 1, "range": 1} and s["subqueries"] == 1


def test_subpackage_may_be_left_out(monkeypatch):
    monkeypatch.setattr(E, "_llm_present", lambda: False)
    assert set(E.queries()) == set(E.QUERIES) and set(E.oracle_sql()) == set(E.QUERIES)


def test_length_charts_scan_the_table_once(spark, tmp_path):
    from vidlens.plans import charts
    lazy = charts.views_by_length(adapter.videos(spark, SF001))
    stored = charts.views_by_length(adapter.videos(spark, SF001), str(tmp_path / "counts"))
    assert all("lineitem" in formatted(d) for d in lazy.values())
    assert not any("lineitem" in formatted(d) for d in stored.values())
    for name in lazy:
        a, b = (d[name].toPandas().sort_values(d[name].columns[:2], ignore_index=True) for d in (lazy, stored))
        assert_frame_equal(a, b, rtol=1e-9)
