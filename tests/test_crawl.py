"""Crawl ingest on a file fixture."""

import os

from pyspark.sql import functions as F

from crawl_fixture import write_tree
from vidlens.sources import crawl


def _load(spark, root):
    return crawl.load_crawls(spark, root)


def test_crawl_dates(spark, tmp_dir):
    root = write_tree(tmp_dir)
    d = {os.path.basename(r["folder"]): r["crawl_date"]
         for r in crawl.crawl_dates(crawl.read_crawl_logs(spark, root)).collect()}
    assert d == {"080609": "080610", "080610": "080611", "080713": None}


def test_load_first_wins_and_skips(spark, tmp_dir):
    root = write_tree(tmp_dir)
    videos, acc = _load(spark, root)
    rows = {r["video_id"]: r for r in videos.collect()}
    # folder without date or log skipped whole; short and bad lines dropped
    assert set(rows) == {"aaa", "bbb", "fff", "ggg", "hhh"}
    assert rows["aaa"]["uploader"] == "u1" and rows["aaa"]["related_ids"] == ["r1", "r2"]
    assert rows["bbb"]["category"] == " UNA " and rows["bbb"]["crawl_date"] == "080610"
    assert rows["bbb"]["related_ids"] == []
    assert rows["fff"]["related_ids"] == []          # trailing tabs stripped
    assert rows["ggg"]["age"] == 3                   # first line of the file wins
    assert rows["hhh"]["related_ids"] == ["a", "b", "c"]
    total = acc.where(F.col("folder").isNull()).collect()[0]
    assert total["lines_read"] == 13
    assert total["lines_read"] == (total["skipped"] + total["short"] + total["bad"]
                                   + total["duplicates"] + total["kept"])
    assert (total["skipped"], total["short"], total["bad"], total["duplicates"], total["kept"]) == (2, 2, 1, 3, 5)


def test_parse_types(spark):
    lines = spark.createDataFrame(
        [("f", "0.txt", 1, "v\tu\t 12 \tc\t5\t6\tnan\t8\t9"),
         ("f", "0.txt", 2, "v\tu\t1e3\tc\t5\t6\t7\t8\t9"),
         ("f", "0.txt", 3, "")],
        "folder string, file_name string, line_pos long, value string")
    out = {r["line_pos"]: r for r in crawl.parse_crawl_lines(lines).collect()}
    assert out[1]["status"] == "ok" and out[1]["age"] == 12      # int(" 12 ") works
    assert out[2]["status"] == "bad"                             # int("1e3") fails
    assert out[3]["status"] == "short"


def test_load_and_store_job(spark, tmp_dir):
    from vidlens.plans import jobs
    root = write_tree(os.path.join(tmp_dir, "crawl"))
    res = jobs.load_and_store(spark, root, os.path.join(tmp_dir, "out"))
    assert res["totals"]["kept"] == 5
    assert spark.read.parquet(res["videos"]).count() == 5


def test_cli_load(spark, tmp_dir):
    from vidlens import cli
    root = write_tree(os.path.join(tmp_dir, "crawl"))
    assert cli.main(["load", root, os.path.join(tmp_dir, "out")]) == 0
    assert cli.main(["count", os.path.join(tmp_dir, "out", "videos")]) == 0


def test_cli_prepare_report_slice(spark, tmp_dir):
    from vidlens import cli
    root = write_tree(os.path.join(tmp_dir, "crawl"))
    out = os.path.join(tmp_dir, "out")
    assert cli.main(["load", root, out]) == 0
    table = os.path.join(tmp_dir, "clean")
    assert cli.main(["prepare", "parquet", os.path.join(out, "videos"), table]) == 0
    assert cli.main(["report", table, os.path.join(tmp_dir, "report"), "--top", "3"]) == 0
    assert "top_3_views" in os.listdir(os.path.join(tmp_dir, "report"))
    assert cli.main(["slice", table, "--age", "0-500", "--page", "0"]) == 0


def test_crawl_date_as_date(spark):
    from vidlens.functions import columns as C
    df = spark.createDataFrame([("080610",), ("0806xx",), (None,)], "crawl_date string")
    got = [r[0] for r in df.select(C.crawl_date_as_date("crawl_date")).collect()]
    assert str(got[0]) == "2008-06-10" and got[1:] == [None, None]


def test_strict_load_raises_on_bad_integer(spark, tmp_dir):
    import pytest
    root = write_tree(tmp_dir)
    with pytest.raises(ValueError, match="unparsable"):
        crawl.load_crawls(spark, root, strict=True)


def test_strip_like_python(spark):
    from vidlens.functions import columns as C
    raw = ["\\x1c a\\tb \\xa0", "\\u3000x\\u2028", "  ", "\\ty\\t\\t"]
    raw = [r.encode().decode("unicode_escape") for r in raw]
    df = spark.createDataFrame([(r,) for r in raw], "v string")
    assert [r[0] for r in df.select(C.strip_ws("v")).collect()] == [r.strip() for r in raw]


def _lineitem(spark, folder, rows=400, years=4, lines=8):
    """A lineitem table of ``rows`` rows, each fourth of them twice under one key with other values."""
    i = F.col("id")
    spark.range(rows).select(
        F.floor(i / 4 / lines).alias("l_orderkey"), (i % 17).alias("l_partkey"), (i * 7 % 5).alias("l_suppkey"),
        (F.floor(i / 4) % lines).cast("int").alias("l_linenumber"), (i % 50).cast("double").alias("l_quantity"),
        (i * 31 % 999).cast("double").alias("l_extendedprice"), F.lit(0.04).alias("l_discount"),
        F.lit(0.02).alias("l_tax"), F.lit("R").alias("l_returnflag"),
        F.timestamp_seconds(F.lit(788961600) + (i % years) * 366 * 86400).alias("l_shipdate")).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_dates_are_attached_without_a_shuffle_by_folder(spark):
    lines = spark.range(10).select(F.concat(F.lit("f"), F.col("id") % 2).alias("folder"), F.lit("0.txt").alias("file_name"),
                                   F.col("id").alias("line_pos"), F.lit("a\tb").alias("value"))
    logs = lines.select("folder", F.concat(F.lit("start:  08061"), F.col("line_pos") % 2).alias("value")).distinct()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # nothing is small by its estimate
    try:
        plan = crawl.dated_lines(lines, logs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_more_lines_are_dealt_over_more_tasks(spark, tmp_dir, monkeypatch):
    from vidlens.plans import adapter
    monkeypatch.setattr(adapter, "DEAL_ROWS", 10, raising=False)
    sf = _lineitem(spark, tmp_dir)
    assert adapter.crawl_lines(spark, sf).rdd.getNumPartitions() == 40


def test_tree_files_stand_in_order_over_many_ranges(spark, tmp_dir, monkeypatch):
    from vidlens.plans import adapter
    monkeypatch.setattr(adapter, "DEAL_ROWS", 13, raising=False)
    sf = _lineitem(spark, os.path.join(tmp_dir, "t"))
    root = adapter.write_crawl_tree(spark, sf, os.path.join(tmp_dir, "tree"))
    parsed = crawl.parse_crawl_lines(adapter.crawl_lines(spark, sf).withColumn("line", F.col("value")))
    want = {}
    for r in parsed.orderBy("folder", "file_name", "line_pos", *crawl.VIDEO_COLUMNS).collect():
        want.setdefault((r["folder"], r["file_name"]), []).append(r["line"])
    got = {}
    for folder, name in want:
        with open(os.path.join(root, folder, name)) as f:
            got[folder, name] = f.read().split("\n")[:-1]
    assert got == want and sum(map(len, got.values())) == 400


def test_splits_of_a_tree_grow_with_it(spark, tmp_dir, monkeypatch):
    import __spark_entry__ as entry
    from vidlens.plans import adapter
    monkeypatch.setattr(adapter, "TREE_SPLITS", 2, raising=False)
    sf = _lineitem(spark, tmp_dir, rows=20_000, years=1, lines=1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    videos, _ = entry._crawl_tree(spark, sf)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert 2 <= len(videos.inputFiles()) <= 4     # 64 KB each: 12
