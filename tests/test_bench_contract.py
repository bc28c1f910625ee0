"""bench.py prints exactly one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"),
                          "completeness,ranges_from_responses,state_after_run"],
                         env=env, capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["metric"] and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"completeness", "ranges_from_responses", "state_after_run"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6
