"""The end-to-end batch run (E1): ingest -> load -> transform.

One function replaces the scheduled task graph. Every stage is a Spark job
whose result is written under ``root`` (a shared folder), so each stage
reads written tables, not a long lineage, and a failed stage can be re-run.

Modes:
  "idempotent" (default): staging is replaced, a batch's fact and discount
      parts are replaced, weather keeps one row per store-day (a run
      replaces the store-days it delivers and keeps all others, month by
      month), and the marts are brought up to date from what changed
      (``plans.refresh``). Readers see each table's new rows once they are
      committed. Running the same batch twice equals running it once.
  "append": every run adds rows as a plain INSERT would (duplicated loads
      double-count; weather duplicates multiply in the join), and marts over
      all rows are appended. This reproduces the original task graph's
      behaviour.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from raincheck.operators import dims, facts, marts
from raincheck.operators.joins import join_store, join_weather_audited
from raincheck.plans.concurrent import concurrently
from raincheck.plans.refresh import month_part, refresh, sync_reductions
from raincheck.session import shuffles_dropped
from raincheck.sources import catalog, csv, payloads, tables

DIM_BUILDERS = {
    "customers": ("dim_customers", dims.dim_customers),
    "employees": ("dim_employees", dims.dim_employees),
    "products": ("dim_products", dims.dim_products),
    "stores": ("dim_stores", dims.dim_stores),
}


@dataclass
class RunResult:
    root: str
    batch_id: str
    audit: dict[str, int] = field(default_factory=dict)
    payloads: int = 0
    failed_payloads: int = 0
    weather_file: str = ""
    unanswered_stores: int = 0                         # staged stores without a successful payload
    defined: list[str] = field(default_factory=list)   # catalog tables that show the written ones
    mart_lines: int = 0                                # lines in the months that were computed
    unmatched_lines: int = 0                           # of these, lines without weather
    mart_months: list[str] = field(default_factory=list)   # months computed by this run
    fact_parts: list[str] = field(default_factory=list)    # fact parts read by this run
    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def phase(self, name: str):
        t0 = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = round(time.perf_counter() - t0, 3)


def load_staging(staging: dict[str, DataFrame], staging_dir: str, mode: str) -> dict[str, int]:
    """Ingest: write each source to its staging table, counting rows."""
    write_mode = "append" if mode == "append" else "overwrite"
    return concurrently({
        name: (lambda n=name, df=df: csv.append_staging(df, staging_dir, n, write_mode))
        for name, df in staging.items()})


def load_weather(spark: SparkSession, payload_frame: DataFrame, root: str, run_date: dt.date,
                 mode: str, result: RunResult, buckets: int | None = None) -> None:
    """Flatten the payloads into the dated weather file, then load the weather
    table from that file: merged by store-day (or appended). Only the months
    that come in are read and written again."""
    obs = Observation("weather_payloads")
    records = payloads.weather_records(payloads.flatten_weather(payload_frame, obs))
    result.weather_file = payloads.write_weather_file(records, root, run_date, result.batch_id)
    got = tables.observed(obs)
    result.payloads, result.failed_payloads = int(got.get("payloads", 0)), int(got.get("failed_payloads", 0))
    incoming = payloads.load_weather(spark, result.weather_file)
    path, month = tables.table_path(root, "dim_store_weather"), tables.month_of("date_id")
    cluster, note = ("store_id", "date_id"), {"buckets": buckets}
    if mode == "append":
        tables.replace_parts(incoming.withColumn("run_date", F.lit(run_date)), path,
                             F.concat(month, F.lit(f"~{uuid.uuid4().hex[:16]}")), set(), buckets, cluster, note=note)
        return
    days = tables.month_start("date_id")
    months = dict(incoming.groupBy(days.alias("m")).count().select(tables.month_of("m"), "count").collect())  # bounded by the calendar
    if not months:
        return
    touched = {p for p in tables.live(spark, path) if month_part(p) in months}
    held = tables.read_table(spark, root, "dim_store_weather", touched)
    if buckets:
        merged = payloads.merge_weather(held, incoming, run_date).select(*held.columns)
    else:
        rows = max(months.values()) + (tables.most_rows(held, days) if touched else 0)
        merged = payloads.merge_weather(held, incoming, run_date, lambda both: tables.in_shares(both, days, rows, *cluster))
    tables.replace_parts(merged, path, month, touched, buckets, cluster, note=note)


def mart_frames(fact: DataFrame, weather: DataFrame, stores: DataFrame, products: DataFrame,
                strict_types: bool = False, audit: Observation | None = None) -> dict[str, DataFrame]:
    """The three marts over all given lines, from the lines themselves: what
    ``refresh`` keeps up to date."""
    lines = fact.select("invoice_id", "store_id", "date", "invoice_total")
    joined = join_weather_audited(lines, weather, audit or Observation(f"lines_{uuid.uuid4().hex[:8]}"))
    region = join_store(marts.as_days(joined), stores)
    return {marts.M1: marts.region_impact_from(region, strict_types),
            marts.M2: marts.product_sensitivity(fact, products, weather, strict_types),
            marts.M3: marts.size_impact(fact, stores, weather, strict_types)}


def build_marts(spark: SparkSession, root: str, mode: str = "idempotent", strict_types: bool = False,
                result: RunResult | None = None, buckets: int | None = None) -> None:
    """Transform: the three marts brought up to date (or, in append mode,
    computed over all rows and appended). Lines without weather drop out of
    every mart; their number is audited (``result.unmatched_lines``)."""
    result = result or RunResult(root=root, batch_id="")

    def timed(name, f):
        def run():
            t0 = time.perf_counter()
            got = f()
            result.seconds[f"marts: {name}"] = round(time.perf_counter() - t0, 3)
            return got
        return run

    if mode == "append":
        audit = Observation("mart_lines")
        frames = mart_frames(tables.read_table(spark, root, "fact_transactions"),
                             tables.read_table(spark, root, "dim_store_weather").drop("run_date"),
                             tables.read_table(spark, root, "dim_stores"),
                             tables.read_table(spark, root, "dim_products"), strict_types, audit)
        concurrently({n: timed(n, lambda n=n, df=df: tables.append_rows(df, tables.table_path(root, n)))
                      for n, df in frames.items()})
        got = tables.observed(audit)
    else:
        got = refresh(spark, root, strict_types, buckets, timed)
        result.mart_months = got["months"]
        result.fact_parts = result.fact_parts + got["parts"]
    result.mart_lines, result.unmatched_lines = int(got.get("lines") or 0), int(got.get("unmatched_lines") or 0)


def run_pipeline(spark: SparkSession, staging: dict[str, DataFrame], payload_frame: DataFrame,
                 root: str, run_date: dt.date, batch_id: str | None = None,
                 mode: str = "idempotent", strict_types: bool = False,
                 database: str | None = None, buckets: int | None = None) -> RunResult:
    """Run ingest, load and transform for one batch.

    ``staging`` maps each source name (customers, discounts, employees,
    products, stores, transactions) to a frame with the CSV header columns,
    e.g. from ``csv.read_sources``. ``payload_frame`` holds the weather
    responses (store_id, status, body). ``database``: the catalog database that
    shows the written tables (created if absent). ``buckets``: cluster the
    reductions and the weather by store and day in so many buckets, so that
    their join needs no exchange; keep it the same for all runs. The number is
    doubled as the fact grows, so that a bucket, which is one task's, stays
    bounded; months written with fewer are exchanged until they are written again.
    """
    if mode not in ("idempotent", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    with shuffles_dropped(spark):
        return _run(spark, staging, payload_frame, root.rstrip("/"), run_date, batch_id or run_date.isoformat(), mode,
                    strict_types, database, buckets)


def _run(spark: SparkSession, staging: dict[str, DataFrame], payload_frame: DataFrame, root: str, run_date: dt.date,
         batch_id: str, mode: str, strict_types: bool, database: str | None, buckets: int | None) -> RunResult:
    """The phases of ``run_pipeline``."""
    result = RunResult(root=root, batch_id=batch_id)
    staging_dir = f"{root}/staging"

    def path(name):
        return tables.table_path(root, name)

    with result.phase("ingest"):
        result.audit = load_staging(staging, staging_dir, mode)
        stg = {name: csv.read_staging(spark, staging_dir, name) for name in staging}
        if buckets:
            held = sum(p.get("rows", 0) for n, p in tables.live(spark, path("fact_transactions")).items()
                       if mode == "append" or n != f"batch {batch_id}")
            buckets = catalog.enough_buckets(buckets, held + result.audit.get("transactions", 0))

    def count_unanswered():
        result.unanswered_stores = payloads.unanswered_requests(
            payloads.weather_requests(stg["stores"]), payload_frame).count()

    def load_fact():
        tables.write_batch(facts.fact_transactions(stg["transactions"]), root, "fact_transactions", batch_id, mode)
        if mode == "idempotent":
            # Needs no weather, so it need not wait for the other loads.
            result.fact_parts = sync_reductions(spark, root, buckets)

    with result.phase("load"):
        loads = {
            table: (lambda t=table, b=build, n=name: tables.append_rows(
                b(stg[n], tables.read_table(spark, root, t)), path(t)))
            for name, (table, build) in DIM_BUILDERS.items()}
        loads["fact_transactions"] = load_fact
        loads["dim_store_weather"] = lambda: load_weather(spark, payload_frame, root, run_date, mode, result, buckets)
        loads["dim_dates"] = lambda: tables.append_rows(
            dims.dim_dates(stg["transactions"], tables.read_table(spark, root, "dim_dates")), path("dim_dates"))
        loads["dim_discounts"] = lambda: tables.write_batch(
            dims.dim_discounts(stg["discounts"]), root, "dim_discounts", batch_id, mode)
        loads["unanswered"] = count_unanswered
        loads["load_audit"] = lambda: tables.put_part(csv.load_audit(spark, staging_dir, list(staging)),
                                                      path("load_audit"), f"batch {batch_id}")
        concurrently(loads)
    with result.phase("marts"):
        concurrently({
            "marts": lambda: build_marts(spark, root, mode, strict_types, result, buckets),
            "truncate": lambda: csv.truncate_staging(spark, staging_dir, list(staging))})
    if database:
        with result.phase("catalog"):
            result.defined = catalog.publish(spark, root, database, strict_types)
    return result


def main(argv: list[str] | None = None) -> RunResult:
    """Command line: one batch run, e.g.

    python -m raincheck.plans.pipeline --sources /shared/retail/exports \\
        --payloads /shared/retail/weather/2025-03-01 --root /shared/retail/warehouse --run-date 2025-03-01

    (or ``spark-submit raincheck/plans/pipeline.py ...`` with the package on
    the Python path).

    ``--sources`` holds the six ``{name}.csv`` files; ``--payloads`` holds
    JSON lines with ``store_id``, ``status`` and ``body`` (the response text).
    """
    import argparse

    from raincheck.session import build_session

    ap = argparse.ArgumentParser(prog="raincheck-pipeline", description=__doc__.splitlines()[0])
    ap.add_argument("--sources", required=True)
    ap.add_argument("--payloads", required=True)
    ap.add_argument("--root", required=True)
    ap.add_argument("--run-date", required=True, type=dt.date.fromisoformat)
    ap.add_argument("--batch-id")
    ap.add_argument("--mode", choices=["idempotent", "append"], default="idempotent")
    ap.add_argument("--strict-types", action="store_true")
    ap.add_argument("--payload-format", choices=["lines", "files"], default="lines",
                    help="lines: JSON lines (store_id, status, body); files: one saved "
                         "response per <store_id>.json file")
    ap.add_argument("--multi-line-transactions", action="store_true",
                    help="allow line breaks inside quoted fields of transactions.csv too "
                         "(each of its files is then read by one task)")
    ap.add_argument("--single-line", default="",
                    help="sources (comma-separated) without line breaks inside quoted fields: "
                         "their files are split over tasks")
    ap.add_argument("--database", help="catalog database that shows the written tables")
    ap.add_argument("--buckets", type=int, help="cluster lines and weather by store and day in so many buckets at least")
    ap.add_argument("--master")
    ap.add_argument("--input-gb", type=float,
                    help="size of the largest input; sizes shuffle partitions and splits")
    a = ap.parse_args(argv)
    spark = build_session(a.master, input_bytes=int(a.input_gb * 2**30) if a.input_gb else None)
    if a.payload_format == "files":
        payload_frame = payloads.read_payload_files(spark, a.payloads)
    else:
        payload_frame = spark.read.schema("store_id int, status int, body string").json(a.payloads)
    single = {n.strip() for n in a.single_line.split(",")}
    multi_line = [n for n in csv.MULTI_LINE_SOURCES + (("transactions",) if a.multi_line_transactions else ())
                  if n not in single]
    result = run_pipeline(spark, csv.read_sources(spark, a.sources, multi_line=multi_line), payload_frame, a.root,
                          a.run_date, a.batch_id, a.mode, a.strict_types, a.database, a.buckets)
    print(result)
    return result


if __name__ == "__main__":
    main()
