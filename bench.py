"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned from the raw driver tables (the retail x weather view
is derived inside the query) and fully executed into Spark's ``noop`` sink,
so no result is collected. Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from raincheck.plans.registry import QUERIES  # noqa: E402
from raincheck.session import build_session  # noqa: E402

HEADLINE = [
    "region_impact", "product_sensitivity", "size_impact",
    "revenue_by_weather_over_time", "top_products_by_weather",
    "revenue_by_size_and_temperature", "transactions_by_weather",
    "category_sales", "category_pivot", "batch_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="raincheck-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # Warm session: run the same queries once on the smallest scale factor
    # beside the measured one, so JVM start, class loading, code generation
    # and JIT are paid before timing (the generated code is the same).
    warm_dir = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.01"))
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    # Best of BENCH_REPEATS runs per query (each run re-plans the query from
    # the raw tables); this machine's run-to-run noise is large.
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    times = {}
    for name in names:
        best = None
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            t = time.perf_counter() - t0
            best = t if best is None else min(best, t)
        times[name] = round(best, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
        "spark": spark.version, "method": f"best of {repeats} warm runs per query",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
