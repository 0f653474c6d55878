"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="weekly_sum_null_preserving,top1_per_group")
    run = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [l for l in run.stdout.splitlines() if l.strip()]
    assert run.returncode == 0 and len(lines) == 1, run.stdout + run.stderr[-2000:]
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"weekly_sum_null_preserving", "top1_per_group"}
