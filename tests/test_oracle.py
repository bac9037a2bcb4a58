"""Every registered query against its DuckDB oracle (the driver's gate)."""

import os
import sys

import duckdb
import pytest

from paths import ROOT, SF001, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "avg_views", "avg_rating"]
    assert len(df.collect()) > 0


def test_every_query_has_oracle():
    # the learned and sampled queries of the subpackage are tested beside it
    assert set(E.ORACLE) == set(E.QUERIES)


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert srows is not None
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


@pytest.mark.parametrize("name", ["related_correlation", "crawl_parse", "coerce_numeric", "tolerant_csv",
                                  "correlation_pairs", "summary_statistics"])
def test_query_matches_oracle_without_ansi(spark, con, name):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = E.queries()[name](spark, SF001)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())


#: Queries whose rows come in an order: key columns, falling (-) or rising (+).
#: ``rest`` stands for every other column, rising, as ties are broken.
IN_ORDER = {
    "top_views": ["-views", "rest"], "top_rating": ["-rating", "rest"], "top_comments": ["-comments_count", "rest"],
    "top_views_500": ["-views", "rest"], "dirty_top_rating": ["-rating", "rest"],
    "category_stats_ranked": ["-avg_views", "+category"], "chart_category_views": ["-avg_views", "+category"],
    "chart_category_views_asc": ["+avg_views", "+category"], "chart_top_videos": ["-views", "+video_id"],
    "trend_monthly": ["+upload_month"], "trend_daily": ["+upload_date"], "trend_reaggregate": ["+upload_date"],
    "correlation_pairs": ["-abs_correlation"], "length_ranges": ["+range_order"],
    "page_sorted": ["-views"], "page": ["rest"], "page_deep": ["rest"], "preview": ["+video_id"],
}


@pytest.mark.parametrize("name", sorted(IN_ORDER))
def test_rows_come_in_order(spark, name):
    df = E.queries()[name](spark, SF01 if name == "page_deep" else SF001)  # the small table ends before that page
    rows, keys = df.collect(), []
    for k in IN_ORDER[name]:
        keys += [f"+{c}" for c in df.columns if c not in {x[1:] for x in keys}] if k == "rest" else [k]
    want = list(rows)
    for k in reversed(keys):  # stable sorts from the last key to the first; nulls last either way
        known = [r for r in want if r[k[1:]] is not None]
        want = sorted(known, key=lambda r: r[k[1:]], reverse=k[0] == "-") + [r for r in want if r[k[1:]] is None]
    assert len(rows) > 1
    assert [tuple(r[k[1:]] for k in keys) for r in rows] == [tuple(r[k[1:]] for k in keys) for r in want]


@pytest.mark.parametrize("name", ["tolerant_csv", "csv_roundtrip", "crawl_parse", "json_roundtrip", "page_indexed"])
def test_pruned_columns_see_the_same_rows(spark, name):
    df = E.queries()[name](spark, SF001)
    n = len(df.collect())
    assert df.count() == n
    for c in df.columns:
        assert len(df.select(c).collect()) == n
