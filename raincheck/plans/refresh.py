"""Keeping the marts up to date from what changed.

The marts are not rebuilt from all lines. For each committed part of the fact
the lines are reduced once to invoice days and product days, by month
(``operators.partials``); a month's rows of the regional mart, its size sums and
its product sums are computed again only when something under the month has
changed; the size and product marts are merged from the months.

What has changed is read off the manifests, not passed in: a fact part without
reductions is reduced; reductions without a fact part go; a month whose inputs
(reductions, weather part, stores) are not those that it was computed from is
computed again. So a run that failed at any point, a batch that was replaced and
weather that arrived late are all caught up by the next run, and a run with
nothing new reads manifests only.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from raincheck.operators import marts, partials
from raincheck.operators.joins import join_weather, join_weather_audited
from raincheck.plans.concurrent import concurrently
from raincheck.sources import catalog, tables

FACT = "fact_transactions"
WEATHER = "dim_store_weather"
BY_MONTH = ("invoice_days", "product_days")


def state_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/state/{name}"


def key_of(part: dict) -> str:
    """What identifies a committed part: its folder, which is never reused."""
    return part["folder"].rsplit("/", 1)[-1]


def month_part(name: str) -> str:
    """Month of a part's name: ``2024-01``, ``2024-01~...``."""
    return name.split("~")[0]


def digest(*what) -> str:
    return hashlib.sha256(json.dumps(what, sort_keys=True).encode()).hexdigest()[:16]


# ---------------------------------------------------------------- reductions of a batch
def reduce_part(spark: SparkSession, root: str, name: str, part: dict, buckets: int | None) -> None:
    """Invoice days and product days of one fact part. Only its lines are read,
    and the invoice numbers given out before."""
    lines = tables.read_table(spark, root, FACT, {name})
    most = 0 if buckets else tables.most_rows(lines, tables.month_start("date"))
    numbers_path, work = state_path(root, "invoice_numbers"), state_path(root, "work")
    by = F.concat(tables.month_of("date"), F.lit(f"~{key_of(part)}"))
    mine = {p for p in tables.live(spark, state_path(root, "product_days")) if p.endswith(f"~{key_of(part)}")}

    def number():
        wanted = lines.select("invoice_id", "store_id", "date", "invoice_total")
        days = partials.invoice_day_lines(wanted)
        held = tables.live(spark, numbers_path)
        start = max((p["next"] for p in held.values()), default=0)
        known = tables.read_parts(spark, numbers_path, partials.INVOICE_NUMBERS)
        placed = tables.write_parts(partials.met_invoices(days, known), work)
        met = spark.read.schema("invoice_id string, invoice_no bigint, at bigint").parquet(*tables.folders(placed, work))
        # The next number is noted with the part: a later batch starts there without reading this one's numbers.
        obs = Observation("numbers")
        new = partials.numbered(met, start).observe(obs, F.max("invoice_no").alias("last"))
        written = tables.write_parts(new, numbers_path)
        last = tables.observed(obs).get("last")
        if last is not None:
            tables.commit(spark, numbers_path, {**held, key_of(written[tables.WHOLE]): {**written[tables.WHOLE], "next": last + 1}})
        fresh = spark.read.schema(partials.INVOICE_NUMBERS).parquet(*tables.folders(written, numbers_path))
        mapping = met.where("invoice_no IS NOT NULL").select("invoice_id", "invoice_no").unionByName(fresh)
        # One exchange by invoice for the reduction and its number; lines without an invoice have no part in it.
        by_invoice = partials.invoice_day_lines(wanted.where("invoice_id IS NOT NULL").repartition("invoice_id"))
        without = partials.invoice_day_lines(wanted.where("invoice_id IS NULL")).withColumn("invoice_no", F.lit(None).cast("bigint"))
        numbered = partials.invoice_days(by_invoice, mapping)
        tables.replace_parts(numbered.unionByName(without.select(*numbered.columns)), state_path(root, "invoice_days"), by,
                             {p for p in tables.live(spark, state_path(root, "invoice_days")) if p.endswith(f"~{key_of(part)}")},
                             buckets, note={"buckets": buckets})
        tables.commit(spark, work, {})                  # never a table's: the folder goes

    def products():
        wanted, places = lines.select("invoice_id", "store_id", "date", "product_id", "quantity", "line_total"), ()
        if not buckets:
            wanted = tables.in_shares(wanted, tables.month_start("date"), most, "store_id", "date", "product_id")
            places = (tables.SHARE,)
        days = partials.product_days(wanted, places)
        tables.replace_parts(days, state_path(root, "product_days"), by, mine, buckets, note={"buckets": buckets})

    concurrently({"invoice_days": number, "product_days": products})


def sync_reductions(spark: SparkSession, root: str, buckets: int | None = None) -> list[str]:
    """Reduce fact parts that have no reductions yet, drop those of parts that
    are gone; the names of the parts that were read."""
    fact = tables.live(spark, tables.table_path(root, FACT))
    keys = {key_of(p) for p in fact.values()}
    done = None
    for name in BY_MONTH:
        path = state_path(root, name)
        held = tables.live(spark, path)
        kept = {n: p for n, p in held.items() if n.split("~")[1] in keys}
        if len(kept) < len(held):
            tables.commit(spark, path, kept)
        have = {n.split("~")[1] for n in kept}
        done = have if done is None else done & have
    todo = [n for n, p in fact.items() if key_of(p) not in done]
    for name in todo:
        reduce_part(spark, root, name, fact[name], buckets)
    return todo


# ---------------------------------------------------------------- months
def inputs_by_month(spark: SparkSession, root: str, strict: bool) -> dict[str, str]:
    """Month -> digest of the parts that its sums are computed from."""
    found: dict[str, list] = {}
    for name, path in [*((n, state_path(root, n)) for n in BY_MONTH), (WEATHER, tables.table_path(root, WEATHER))]:
        for part, at in tables.live(spark, path).items():
            found.setdefault(month_part(part), []).append([name, part, at["folder"], at["sub"]])
    return {m: digest(strict, sorted(parts)) for m, parts in found.items()}


def months_of_new_stores(spark: SparkSession, root: str, months: dict[str, dict]) -> set[str]:
    """Months with lines of stores that were added after the month was computed."""
    path = tables.table_path(root, "dim_stores")
    held = tables.live(spark, path)
    before = {m for m, at in months.items() if set(held) - set(at["stores"])}
    new = {n for m in before for n in held if n not in months[m]["stores"]}
    if not new:
        return set()
    days_path = state_path(root, "invoice_days")
    names = {n for n in tables.live(spark, days_path) if month_part(n) in before}
    days = tables.read_parts(spark, days_path, partials.INVOICE_DAYS, names).select("store_id", "date")
    added = tables.read_table(spark, root, "dim_stores", new).select("store_id")
    found = days.join(added, "store_id", "left_semi").select(tables.month_of("date").alias("m")).distinct()
    return {r[0] for r in found.collect()}                 # bounded by the calendar


def _days(spark, root, name, schema, months, buckets) -> DataFrame:
    path = state_path(root, name)
    names = {n for n in tables.live(spark, path) if month_part(n) in months}
    return read(spark, path, schema, names, buckets, ("store_id", "date"))


def read(spark, path, schema, names, buckets, cluster) -> DataFrame:
    """Parts of a table; as a bucketed table if all were written in so many buckets."""
    parts = tables.live(spark, path)
    if buckets and names and all(parts[n].get("buckets") == buckets for n in names):
        return catalog.read_bucketed(spark, path, spark.createDataFrame([], schema).schema, buckets, names, cluster)
    return tables.read_parts(spark, path, schema, names)


def weather_of(spark: SparkSession, root: str, months, buckets=None) -> DataFrame:
    path = tables.table_path(root, WEATHER)
    names = {n for n in tables.live(spark, path) if month_part(n) in months}
    return read(spark, path, tables.table_schema(WEATHER), names, buckets, ("store_id", "date_id")).drop("run_date")


def month_inputs(spark, root, months, buckets=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Invoice days, product days and weather of the months."""
    return (_days(spark, root, "invoice_days", partials.INVOICE_DAYS, months, buckets),
            _days(spark, root, "product_days", partials.PRODUCT_DAYS, months, buckets),
            weather_of(spark, root, months, buckets))


def refresh(spark: SparkSession, root: str, strict: bool = False, buckets: int | None = None, timed=None) -> dict:
    """Bring the three marts up to date. Returns the fact parts that were read
    (``parts``), the months computed (``months``) and, over these, the ``lines``
    and the ``unmatched_lines`` without weather."""
    root = root.rstrip("/")
    timed = timed or (lambda name, f: f)
    read_parts = sync_reductions(spark, root, buckets)
    now = inputs_by_month(spark, root, strict)
    months_path = state_path(root, "months")
    was = tables.live(spark, months_path)
    stores_now = sorted(tables.live(spark, tables.table_path(root, "dim_stores")))
    same = {m: was[m] for m in now if m in was and was[m]["inputs"] == now[m]}
    touched = (set(now) | set(was)) - set(same)
    touched |= months_of_new_stores(spark, root, same)
    result = {"parts": read_parts, "months": sorted(touched), "lines": 0, "unmatched_lines": 0}

    if touched:
        days, product_days, weather = month_inputs(spark, root, touched, buckets)
        stores = tables.read_table(spark, root, "dim_stores")
        audit = Observation("mart_lines")

        # Invoice days meet their weather once, for both marts that are made of them.
        work = state_path(root, "matched_days")

        def match():
            both = join_weather_audited(days, weather, audit, weight="lines")
            return tables.folders(tables.write_parts(partials.matched_days(both, stores), work), work)

        def invoices():
            matched = spark.read.schema(partials.MATCHED_DAYS).parquet(*timed("matched_days", match)())
            concurrently({"region": timed(marts.M1, lambda: region(matched)), "sizes": timed("size_months", lambda: sizes(matched))})
            tables.commit(spark, work, {})              # never a table's: the folder goes

        def region(matched):
            path = tables.table_path(root, marts.M1)
            tables.replace_parts(partials.region_impact_by_place(matched, stores, strict), path,
                                 tables.month_of("sale_date"), touched | (set(tables.live(spark, path)) - set(now)))

        def sizes(matched):
            month = tables.month_start("date")
            tables.replace_parts(partials.size_months(matched, month), state_path(root, "size_months"),
                                 tables.month_of("month"), touched, drop="month")

        def products():
            month = tables.month_start("date").alias("month")
            matched = join_weather(product_days, weather, cols=("temp_max", "is_rain"))
            tables.replace_parts(partials.product_months(matched, month), state_path(root, "product_months"),
                                 tables.month_of("month"), touched, drop="month")

        concurrently({"invoices": invoices, "products": timed("product_months", products)})
        got = tables.observed(audit)
        result["lines"], result["unmatched_lines"] = int(got.get("lines") or 0), int(got.get("unmatched_lines") or 0)
    # Months that were not computed have no line of the stores that they did not know.
    computed = {m: {"folder": "", "sub": "", "of": 1, "inputs": now[m], "stores": stores_now} for m in now}
    if computed != was:
        tables.commit(spark, months_path, computed)
    concurrently({
        "size_impact": timed(marts.M3, lambda: merge(
            spark, root, marts.M3, ["size_months"], strict, lambda: partials.size_impact_merged(
                tables.read_parts(spark, state_path(root, "size_months"), partials.SIZE_MONTHS), strict))),
        "product_sensitivity": timed(marts.M2, lambda: merge(
            spark, root, marts.M2, ["product_months", "dim_products"], strict, lambda: partials.product_sensitivity_merged(
                tables.read_parts(spark, state_path(root, "product_months"), partials.PRODUCT_MONTHS),
                tables.read_table(spark, root, "dim_products"), strict)))})
    return result


def merge(spark: SparkSession, root: str, mart: str, sources: list[str], strict: bool, build) -> None:
    """Write a mart again if the parts that it is merged from have changed."""
    parts = [tables.live(spark, state_path(root, s) if s.endswith("_months") else tables.table_path(root, s)) for s in sources]
    inputs = digest(strict, [sorted([n, p["folder"], p["sub"]] for n, p in ps.items()) for ps in parts])
    path = tables.table_path(root, mart)
    held = tables.live(spark, path)
    if set(held) != {tables.WHOLE} or held[tables.WHOLE].get("inputs") != inputs:
        tables.replace_table(build(), path, inputs=inputs)
