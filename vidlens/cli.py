"""Command line: ``python -m vidlens.cli <command> ...``.

  load    <crawl_root> <out_dir>            crawl tree -> Parquet table + accounting
  prepare <fmt> <source> <table_path>       clean any source and store it as Parquet
  report  <table_path> <out_dir> [--top N]  statistics, top-N, categories, trends, charts as CSV
  count   <table_path>                      the counted example predicates
  slice   <table_path> [--age lo-hi] [--views lo-hi] [--rating lo-hi] [--page P]
"""

from __future__ import annotations

import argparse
import json

from vidlens import get_spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="vidlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load"); p.add_argument("root"); p.add_argument("out"); p.add_argument("--strict", action="store_true")
    p = sub.add_parser("prepare"); p.add_argument("fmt"); p.add_argument("source"); p.add_argument("table")
    p = sub.add_parser("report"); p.add_argument("table"); p.add_argument("out"); p.add_argument("--top", type=int, default=10)
    p = sub.add_parser("count"); p.add_argument("table")
    p = sub.add_parser("slice"); p.add_argument("table")
    for b in ("age", "views", "rating"):
        p.add_argument(f"--{b}", default="")
    p.add_argument("--page", type=int, default=0)
    a = ap.parse_args(argv)

    spark = get_spark()
    from vidlens.operators import filters
    from vidlens.plans import jobs
    from vidlens.sources import tables
    if a.cmd == "load":
        print(json.dumps(jobs.load_and_store(spark, a.root, a.out, a.strict), default=str))
    elif a.cmd == "prepare":
        jobs.prepare(tables.read_table(spark, a.fmt, a.source), a.table)
    elif a.cmd == "report":
        jobs.report(spark.read.parquet(a.table), a.out, top_n=a.top)
    elif a.cmd == "count":
        for r in filters.count_matches(spark.read.parquet(a.table)).collect():
            print(f"{r['query']}\t{r['matched']}")
    elif a.cmd == "slice":
        df = spark.read.parquet(a.table)
        jobs.interactive_slice(df, {"age": a.age, "views": a.views, "rating": a.rating}, a.page).show(100, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
