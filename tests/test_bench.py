"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(small_sf):
    env = dict(os.environ, BENCH_SF_DIR=small_sf, BENCH_WARM_DIR=small_sf, BENCH_CPUS="2",
               BENCH_REPEATS="1", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "category_sales"],
                         capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and d["value"] > 0
    assert set(d["queries"]) == {"category_sales"} and d["sf"] == 0.001
