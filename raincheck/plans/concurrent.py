"""Independent Spark actions as concurrent jobs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor


def concurrently(tasks: dict) -> dict:
    """Run independent Spark actions as concurrent jobs (one driver thread
    each), so small jobs share the cluster instead of queueing; returns
    each task's result and re-raises the first failure."""
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(len(tasks), 8)) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}
