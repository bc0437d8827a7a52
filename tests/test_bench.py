"""bench.py prints exactly one JSON line on stdout."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_PARTITIONS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "q3_post_counts"],
                         env=env, capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"q3_post_counts"}
    assert d["value"] == sum(d["queries"].values()) or abs(d["value"] - sum(d["queries"].values())) < 1e-6
