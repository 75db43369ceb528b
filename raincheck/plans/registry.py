"""Named queries over the retail x weather fixture, one per operator.

Each entry takes (spark, sf_dir) and returns a DataFrame whose integer
columns are BIGINT and whose exact decimals are presented as DOUBLE, so
results compare across engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raincheck import schemas as S
from raincheck.functions.dates import day_trunc
from raincheck.functions.weather import rain_flag, temperature_range, weather_label
from raincheck.operators import adhoc, aggregates, dims, facts, joins, marts, reports, windows
from raincheck.plans import pipeline
from raincheck.plans.fixture import RetailFixture
from raincheck.session import scratch_path
from raincheck.sources import csv, payloads, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, decimals as DOUBLE (after exact arithmetic)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(out)


class Inputs:
    """The typed tables an analyst would read, built from the fixture."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.fx = RetailFixture(spark, sf_dir)

    @property
    def fact(self) -> DataFrame:
        return facts.fact_transactions(self.fx.staging_transactions)

    @property
    def stores(self) -> DataFrame:
        return dims.dim_stores(self.fx.staging_stores)

    @property
    def products(self) -> DataFrame:
        return dims.dim_products(self.fx.staging_products)

    @property
    def weather(self) -> DataFrame:
        """Weather records (rain flag, weather-table types). They equal the
        flattened payloads row for row (``store_weather`` checks the payload
        route); the marts skip that JSON round trip."""
        return payloads.store_weather(payloads.weather_records(self.fx.staging_weather))


@query("top_products_by_weather")
def q_top_products_by_weather(spark, d):
    i = Inputs(spark, d)
    return present(reports.top_products_by_weather(i.fact, i.products, i.weather))


# ---------------------------------------------------------------- D1-D8
@query("dim_dates")
def q_dim_dates(spark, d):
    return present(dims.dim_dates(RetailFixture(spark, d).staging_transactions))


@query("dim_customers")
def q_dim_customers(spark, d):
    return present(dims.dim_customers(RetailFixture(spark, d).staging_customers))


@query("dim_discounts")
def q_dim_discounts(spark, d):
    return present(dims.dim_discounts(RetailFixture(spark, d).staging_discounts))


@query("dim_employees")
def q_dim_employees(spark, d):
    return present(dims.dim_employees(RetailFixture(spark, d).staging_employees))


@query("dim_products")
def q_dim_products(spark, d):
    return present(Inputs(spark, d).products)


@query("dim_stores")
def q_dim_stores(spark, d):
    return present(Inputs(spark, d).stores)


@query("fact_transactions")
def q_fact_transactions(spark, d):
    return present(Inputs(spark, d).fact)


@query("flatten_weather")
def q_flatten_weather(spark, d):
    return present(payloads.flatten_weather(RetailFixture(spark, d).weather_payloads))


@query("rain_flag")
def q_rain_flag(spark, d):
    flat = payloads.flatten_weather(RetailFixture(spark, d).weather_payloads)
    return present(flat.select("store_id", "date_id", "precipitation",
                               rain_flag("precipitation").alias("is_rain")))


@query("store_weather")
def q_store_weather(spark, d):
    flat = payloads.flatten_weather(RetailFixture(spark, d).weather_payloads)
    return present(payloads.store_weather(payloads.weather_records(flat)))


@query("insert_if_absent")
def q_insert_if_absent(spark, d):
    """Existing = customers with even keys; the batch has every key twice,
    renamed, in input order ' (new)' then ' (newer)': existing rows stay,
    and the first batch row wins for the others."""
    stg = RetailFixture(spark, d).staging_customers
    existing = dims.dim_customers(stg).filter(F.col("customer_id") % 2 == 0)
    name = F.col("Name")
    batch = (stg.withColumn("Name", F.concat(name, F.lit(" (new)"))).withColumn(dims.SEQ, F.lit(1))
             .unionByName(stg.withColumn("Name", F.concat(name, F.lit(" (newer)")))
                          .withColumn(dims.SEQ, F.lit(2))))
    added = dims.dim_customers(batch, existing)
    return present(existing.unionByName(added))


# ---------------------------------------------------------------- J1-J3
def _lines(i: Inputs, *cols):
    return i.fact.select("invoice_id", "line", *cols)


@query("join_store")
def q_join_store(spark, d):
    i = Inputs(spark, d)
    return present(joins.join_store(_lines(i, "store_id", "date", "invoice_total"), i.stores))


@query("join_weather")
def q_join_weather(spark, d):
    i = Inputs(spark, d)
    return present(joins.join_weather(_lines(i, "store_id", "date", "invoice_total"), i.weather))


@query("join_product")
def q_join_product(spark, d):
    i = Inputs(spark, d)
    return present(joins.join_product(_lines(i, "product_id", "quantity", "line_total"), i.products))


# ---------------------------------------------------------------- A1-A6
@query("min_max_date")
def q_min_max_date(spark, d):
    mm = dims.min_max_date(RetailFixture(spark, d).staging_transactions)
    return mm.select(F.col("lo").alias("min_date"), F.col("hi").alias("max_date"))


@query("count_distinct")
def q_count_distinct(spark, d):
    return present(aggregates.invoice_counts(Inputs(spark, d).fact, ["store_id"]))


@query("count_col")
def q_count_col(spark, d):
    return present(aggregates.line_counts(Inputs(spark, d).fact, ["product_id"]))


@query("sum_numeric")
def q_sum_numeric(spark, d):
    return present(aggregates.line_sums(Inputs(spark, d).fact, ["store_id"]))


@query("avg_numeric")
def q_avg_numeric(spark, d):
    return present(aggregates.temperature_averages(Inputs(spark, d).weather, ["store_id"]))


@query("group_by_expr")
def q_group_by_expr(spark, d):
    return present(aggregates.days_by_temperature_range(Inputs(spark, d).weather))


# ---------------------------------------------------------------- P5, P8, P9, P11, P14
@query("temperature_range")
def q_temperature_range(spark, d):
    w = Inputs(spark, d).weather
    return present(w.select("store_id", "date_id", "temp_max",
                            temperature_range("temp_max").alias("temperature_range")))


@query("weather_label")
def q_weather_label(spark, d):
    w = Inputs(spark, d).weather
    return present(w.select("store_id", "date_id", "is_rain",
                            weather_label("is_rain").alias("weather_condition")))


@query("store_size_tier")
def q_store_size_tier(spark, d):
    return present(Inputs(spark, d).stores.select("store_id", "number_of_employees", "size"))


@query("day_trunc")
def q_day_trunc(spark, d):
    f = Inputs(spark, d).fact
    return present(f.groupBy(day_trunc("datetime").alias("sale_date"))
                    .agg(F.count(F.lit(1)).alias("lines")))


@query("day_offset")
def q_day_offset(spark, d):
    dd = dims.dim_dates(RetailFixture(spark, d).staging_transactions)
    return dd.select("date_id", payloads.weather_file_day(F.col("date_id")).alias("weather_file_day"))


# ---------------------------------------------------------------- W1-W3
@query("rank_over_aggregate")
def q_rank_over_aggregate(spark, d):
    i = Inputs(spark, d)
    g = reports.product_revenue_by_weather(i.fact, i.products, i.weather)
    return present(windows.rank_over_aggregate(g, "is_rain", "total_revenue"))


@query("top_n_per_group")
def q_top_n_per_group(spark, d):
    i = Inputs(spark, d)
    g = reports.product_revenue_by_weather(i.fact, i.products, i.weather)
    return present(windows.top_n_per_group(g, "is_rain", "total_revenue", 5))


def _m1(i: Inputs) -> DataFrame:
    return marts.region_impact(i.fact, i.stores, i.weather)


def _m3(i: Inputs) -> DataFrame:
    return marts.size_impact(i.fact, i.stores, i.weather)


@query("share_of_total")
def q_share_of_total(spark, d):
    return present(reports.transactions_by_weather(_m1(Inputs(spark, d)), with_share=True))


# ---------------------------------------------------------------- M1-M3
@query("region_impact")
def q_region_impact(spark, d):
    return present(_m1(Inputs(spark, d)))


@query("product_sensitivity")
def q_product_sensitivity(spark, d):
    i = Inputs(spark, d)
    return present(marts.product_sensitivity(i.fact, i.products, i.weather))


@query("size_impact")
def q_size_impact(spark, d):
    return present(_m3(Inputs(spark, d)))


# ---------------------------------------------------------------- Q1, Q3, Q4
@query("revenue_by_weather_over_time")
def q_revenue_by_weather_over_time(spark, d):
    return present(reports.revenue_by_weather_over_time(_m1(Inputs(spark, d))))


@query("revenue_by_size_and_temperature")
def q_revenue_by_size_and_temperature(spark, d):
    return present(reports.revenue_by_size_and_temperature(_m3(Inputs(spark, d))))


@query("transactions_by_weather")
def q_transactions_by_weather(spark, d):
    return present(reports.transactions_by_weather(_m1(Inputs(spark, d))))


# ---------------------------------------------------------------- X1-X3
#: The part types of the driver's tables (fixed values): the wide pivot's columns.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("category_sales")
def q_category_sales(spark, d):
    i = Inputs(spark, d)
    return present(adhoc.category_sales(i.fact, i.products))


@query("category_totals")
def q_category_totals(spark, d):
    i = Inputs(spark, d)
    return present(adhoc.category_totals(i.fact, i.products))


@query("category_pivot")
def q_category_pivot(spark, d):
    i = Inputs(spark, d)
    return present(adhoc.category_pivot(i.fact, i.products, CATEGORIES))


@query("category_maps")
def q_category_maps(spark, d):
    """X3 without a list of categories: the maps, written out."""
    i = Inputs(spark, d)

    def text(m):
        return F.expr(f"array_join(transform(map_entries({m}), e -> concat(e.key, '=', cast(e.value AS string))), ';')").alias(m)

    maps = adhoc.category_maps(i.fact, i.products)
    return present(maps.select("store_id", "date", F.size("quantity").alias("categories"), text("quantity"), text("amount")))


# ---------------------------------------------------------------- O1-O3
def _placed(ordered: DataFrame, keys: list[str]) -> DataFrame:
    """The place at which rows with these keys begin in a sorted frame. The
    panels hold a row per day and flag at most."""
    at = ordered.withColumn("_at", F.monotonically_increasing_id())
    first = at.withColumn("_first", F.min("_at").over(Window.partitionBy(*keys)))
    return first.withColumn("position", F.rank().over(Window.orderBy("_first"))).drop("_at", "_first")


@query("sorted_time_series")
def q_sorted_time_series(spark, d):
    return present(_placed(reports.revenue_by_weather_over_time(_m1(Inputs(spark, d))), ["time"]).drop("value"))


@query("sorted_top_products")
def q_sorted_top_products(spark, d):
    i = Inputs(spark, d)
    top = reports.top_products_by_weather(i.fact, i.products, i.weather, keep_rank=True)
    return present(_placed(top, ["weather_condition", "rank"]).drop("total_revenue"))


@query("sorted_sizes")
def q_sorted_sizes(spark, d):
    return present(_placed(reports.revenue_by_size_and_temperature(_m3(Inputs(spark, d))),
                           ["store_size", "temperature_range"]).drop("total_revenue"))


# ---------------------------------------------------------------- S1-S9, E1, R2
RUN_DATE = dt.date(2025, 3, 1)


def fixture_staging(fx: RetailFixture) -> dict[str, DataFrame]:
    return {"customers": fx.staging_customers, "discounts": fx.staging_discounts,
            "employees": fx.staging_employees, "products": fx.staging_products,
            "stores": fx.staging_stores, "transactions": fx.staging_transactions}


def two_exports(df: DataFrame, path: str, key: str) -> str:
    """A source as two exports in one folder: the second has its columns in
    reverse order and one more."""
    odd = F.pmod(F.col(f"`{key}`").cast("bigint"), F.lit(2)) == 1
    csv.write_csv(df.where(~odd), f"{path}/export-0")
    csv.write_csv(df.where(odd).select(*[F.col(f"`{c}`") for c in reversed(df.columns)], F.lit("x").alias("Not Ours")),
                  f"{path}/export-1")
    return path


@query("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    """S1 + P10: staged lines written as CSV text, scanned back by column
    name with null tokens, then loaded into the fact shape. One folder holds
    two exports with different headers, and a text cell with padding, a quote
    and a line break in every row."""
    fx = RetailFixture(spark, d)
    stg = fx.staging_transactions.withColumn(
        "Color", F.concat(F.lit("  \"a\"\n"), F.col("`Product ID`").cast("string"), F.lit(" ")))
    path = two_exports(stg, scratch_path(spark, "csv") + "/transactions.csv", "Product ID")
    back = csv.scan_csv(spark, path, S.CSV_HEADERS["transactions"], multi_line=True)
    return present(facts.fact_transactions(back))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("load_audit")
def q_load_audit(spark, d):
    """S1 + S2 + S3: each source as two exports with different headers, loaded;
    rows per staging table and source file, beside the rows counted while
    writing."""
    fx = RetailFixture(spark, d)
    src, staging_dir = scratch_path(spark, "exports"), scratch_path(spark, "staging")
    keys = {"customers": "Customer ID", "employees": "Employee ID", "products": "Product ID", "stores": "Store ID"}
    staging = fixture_staging(fx)
    staging["transactions"] = staging["transactions"].withColumn("_key", F.regexp_extract("`Invoice ID`", r"\d+", 0))
    staging["discounts"] = fx.staging_discounts_with("p_partkey").withColumnRenamed("p_partkey", "_key")
    pipeline.concurrently({n: (lambda n=n, df=df: two_exports(df, f"{src}/{n}.csv", keys.get(n, "_key")))
                           for n, df in staging.items()})
    loaded = pipeline.load_staging(csv.read_sources(spark, src), staging_dir, "append")
    counted = csv.load_audit(spark, staging_dir).groupBy(
        "table_name", F.regexp_extract("file", r"/export-(\d)/", 1).cast("bigint").alias("export")).agg(
        F.sum("rows").alias("rows"))
    observed = F.create_map(*[F.lit(x) for n, k in loaded.items() for x in (csv.STAGING_TABLES[n], k)])
    return present(counted.withColumn("loaded_rows", observed[F.col("table_name")].cast("bigint")))


@query("truncate_staging")
def q_truncate_staging(spark, d):
    """S2 + S8 + S9: staging tables loaded, then emptied; rows read back
    before and after."""
    fx = RetailFixture(spark, d)
    staging_dir = scratch_path(spark, "staging")
    names = list(fixture_staging(fx))
    for n, df in fixture_staging(fx).items():
        csv.append_staging(df, staging_dir, n)
    # The loaded version stays readable beside the emptied one.
    loaded = {n: csv.read_staging(spark, staging_dir, n) for n in names}
    csv.truncate_staging(spark, staging_dir, names)
    frames = []
    for n in names:
        before = loaded[n].agg(F.count(F.lit(1)).alias("rows_before"))
        after = csv.read_staging(spark, staging_dir, n).agg(F.count(F.lit(1)).alias("rows_after"))
        frames.append(before.crossJoin(after).select(          # one row each
            F.lit(csv.STAGING_TABLES[n]).alias("table_name"), "rows_before", "rows_after"))
    return _union(frames)


@query("weather_file")
def q_weather_file(spark, d):
    """S5 + S6: the dated weather file, written and read back."""
    records = payloads.weather_records(payloads.flatten_weather(RetailFixture(spark, d).weather_payloads))
    path = payloads.write_weather_file(records, scratch_path(spark, "weather-file"), RUN_DATE, "b1")
    return present(payloads.load_weather(spark, path))


@query("batch_run")
def q_batch_run(spark, d):
    """E1 (+ S7): one full batch into a fresh folder; columns as written and
    rows per table."""
    fx = RetailFixture(spark, d)
    root = scratch_path(spark, "pipeline")
    pipeline.run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN_DATE)
    return tables.row_counts(spark, root)


@query("catalog_tables")
def q_catalog_tables(spark, d):
    """E1 + S7 + J2: one full batch, clustered by store and day, read through
    the catalog: columns as declared there and rows per table."""
    fx = RetailFixture(spark, d)
    root, database = scratch_path(spark, "pipeline"), f"raincheck_{uuid.uuid4().hex[:12]}"
    pipeline.run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN_DATE, database=database, buckets=4)
    frames = []
    for name in S.TABLES:
        shown = spark.table(f"{database}.{name}").drop(tables.PART)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shown.schema.fields)
        frames.append(shown.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(columns).alias("columns"), "rows"))
    return _union(frames)


@query("batch_marts")
def q_batch_marts(spark, d):
    """E1 over two batches: the second run of the day delivers the other
    half of the stores' weather and one store's request fails; the rows of
    the three marts that ``run_pipeline`` has written, as (mart, keys,
    numbers)."""
    fx = RetailFixture(spark, d)
    root = scratch_path(spark, "pipeline")
    stg, answers = fixture_staging(fx), fx.weather_payloads
    even = F.col("store_id") % 2 == 0
    nothing = {**stg, "transactions": stg["transactions"].limit(0)}
    pipeline.run_pipeline(spark, nothing, answers.where(even), root, RUN_DATE, "b1")
    second = answers.where(~even).unionByName(answers.where(F.col("store_id") == 2).withColumn("status", F.lit(500)))
    pipeline.run_pipeline(spark, stg, second, root, RUN_DATE, "b2")

    def rows(name, keys, numbers):
        t = present(tables.read_table(spark, root, name))
        return t.select(F.lit(name).alias("mart"),
                        F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys]).alias("keys"),
                        *[F.col(c).cast("double").alias(f"n{i}") for i, c in enumerate(numbers)])
    return _union([
        rows(marts.M1, ["country", "city", "store_size", "is_rain", "sale_date"],
             ["transaction_count", "total_revenue", "avg_temp_max", "avg_temp_min"]),
        rows(marts.M2, ["product_id", "category", "sub_category", "is_rain", "temperature_range"],
             ["transaction_count", "total_quantity", "total_revenue", "total_revenue"]),
        rows(marts.M3, ["store_size", "is_rain", "temperature_range"],
             ["transaction_count", "avg_transaction_value", "total_revenue", "total_revenue"])])


@query("merge_weather")
def q_merge_weather(spark, d):
    """R2 through the pipeline's weather table: two runs share store-days;
    the newer run wins there and the older run's other days are kept. Run 2
    covers even stores on even day numbers, one degree warmer."""
    fx = RetailFixture(spark, d)
    root = scratch_path(spark, "weather")
    dn = F.datediff("date_id", F.lit("1995-01-01").cast("date"))
    newer = fx.staging_weather.filter((F.col("store_id") % 2 == 0) & (dn % 2 == 0)).withColumn(
        "temp_max", (F.col("temp_max") + 1).cast("decimal(5,2)"))
    for day, rows in ((1, fx.staging_weather), (2, newer)):
        result = pipeline.RunResult(root=root, batch_id=f"b{day}")
        pipeline.load_weather(spark, fx.payloads_of(rows), root, dt.date(2025, 3, day), "idempotent", result)
    return present(tables.read_table(spark, root, "dim_store_weather"))


@query("weather_requests")
def q_weather_requests(spark, d):
    """The forecast requests of the staged stores, and whether a payload
    came; stores without a shipment have none."""
    fx = RetailFixture(spark, d)
    requests = payloads.weather_requests(fx.staging_stores)
    open_ = payloads.unanswered_requests(requests, fx.weather_payloads).select("store_id", F.lit(False).alias("a"))
    return present(requests.join(open_, "store_id", "left").withColumn(
        "answered", F.coalesce("a", F.lit(True))).drop("a"))
