"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from paths import ROOT, SF001


def test_bench_runs_and_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="4", BENCH_WARM_DIR="/nonexistent")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    rec = json.loads(out[-1])
    assert rec["unit"] == "sec" and rec["value"] > 0 and rec["sf"] == "0.001"
    assert set(rec["queries"]) >= {"category_stats", "summary_statistics", "crawl_load_files"}
    assert rec["crawl_lines"] > 0 and rec["crawl_records_per_sec"] > 0
