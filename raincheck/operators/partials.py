"""Mergeable partial results of the marts.

Two reductions of the lines that need no weather, kept for each batch:

* ``invoice_days``: one row per store, day and invoice (number)
* ``product_days``: one row per store, day and product; the weather is joined
  below them, so lines that share a store, day and product are joined once (M2)

and two reductions of a month that the marts are merged from:

* ``size_months``: per size, rain and temperature range, sums and the *set* of
  invoices as bitmaps over dense invoice numbers, so that an exact distinct
  count merges: months are or-ed, then counted
* ``product_months``: sums per product, rain and temperature range

Invoices are numbered in order of their first day, so the invoices of a month
lie close together and fill few bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raincheck import schemas as S
from raincheck.functions.dates import day_trunc
from raincheck.functions.numeric import exact_ratio, exact_sum
from raincheck.functions.weather import temperature_range
from raincheck.operators.conform import conform
from raincheck.operators.joins import join_product
from raincheck.operators.marts import M1, M2, M3

INVOICE_NUMBERS = "invoice_id string, invoice_no bigint"
INVOICE_DAYS = "store_id int, date date, invoice_no bigint, lines bigint, totals bigint, revenue decimal(20,0)"
PRODUCT_DAYS = "store_id int, date date, product_id int, lines bigint, quantity bigint, amount decimal(28,4)"
MATCHED_DAYS = ("place int, store_size string, is_rain boolean, temp_max decimal(5,2), temp_min decimal(5,2), date date, "
                "invoice_no bigint, lines bigint, totals bigint, revenue bigint")
SIZE_MONTHS = ("store_size string, is_rain boolean, temperature_range string, bucket bigint, invoices binary, "
               "totals bigint, revenue decimal(30,0)")
PRODUCT_MONTHS = ("product_id int, is_rain boolean, temperature_range string, lines bigint, quantity bigint, "
                  "amount decimal(38,4)")
#: Bits of ``monotonically_increasing_id`` that count rows within a partition (fixed by Spark).
ROW_BITS = 33


# ---------------------------------------------------------------- per batch
def invoice_day_lines(fact: DataFrame) -> DataFrame:
    """Lines -> one row per store, day and invoice. Lines that lie together by
    invoice stay there, and meet the invoice's number without another exchange."""
    # Whole units are added as a bigint, which a hash table holds in place.
    return fact.groupBy("store_id", "date", "invoice_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count("invoice_total").alias("totals"),
        F.sum(F.col("invoice_total").cast("bigint")).cast("decimal(20,0)").alias("revenue"))


def product_days(fact: DataFrame, places=()) -> DataFrame:
    """Lines -> one row per store, day and product. ``places``: columns that say
    where the rows are to be written (``tables.in_shares``), kept."""
    return fact.groupBy(*places, "store_id", "date", "product_id").agg(
        F.count("invoice_id").alias("lines"), F.sum("quantity").alias("quantity"),
        exact_sum("line_total").alias("amount"))


def met_invoices(days: DataFrame, known: DataFrame) -> DataFrame:
    """The batch's invoices with their numbers, if they have one already, and
    the place of each in the order of first days (``at``: partition and row)."""
    ids = days.where(F.col("invoice_id").isNotNull()).groupBy("invoice_id").agg(F.min("date").alias("first_day"))
    order = ["first_day", "invoice_id"]
    return (ids.join(known, "invoice_id", "left").repartitionByRange(*order).sortWithinPartitions(*order)
            .select("invoice_id", "invoice_no", F.monotonically_increasing_id().alias("at")))


def numbered(met: DataFrame, start: int) -> DataFrame:
    """Invoices without a number get the next ones, dense, in their order.
    ``met`` has been written: its places don't change between readings."""
    new = met.where(F.col("invoice_no").isNull())
    part = F.shiftright("at", ROW_BITS)
    # Rows with a number leave gaps between the places of those without.
    place = F.row_number().over(Window.partitionBy("part").orderBy("at"))
    rows = new.select("invoice_id", "at", part.alias("part")).withColumn("place", place)
    # One row a partition of the written table: a window over a handful of rows.
    before = rows.groupBy("part").agg(F.max("place").alias("n")).select(
        "part", (F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                 + F.lit(start)).alias("before"))
    return rows.join(before, "part").select("invoice_id", (F.col("before") + F.col("place") - 1).alias("invoice_no"))


def invoice_days(days: DataFrame, numbers: DataFrame) -> DataFrame:
    """Invoice days by number; lines without an invoice keep none."""
    return days.join(numbers, "invoice_id", "left").select("store_id", "date", "invoice_no", "lines", "totals", "revenue")


# ---------------------------------------------------------------- per month
def places_of(stores: DataFrame) -> DataFrame:
    """Stores with their ``place``: the first of the stores that share country, city and size."""
    return stores.select("store_id", "country", "city", F.col("size").alias("store_size"),
                         F.min("store_id").over(Window.partitionBy("country", "city", "size")).alias("place"))


def matched_days(days: DataFrame, stores: DataFrame) -> DataFrame:
    """Invoice days with weather -> with the store's place and size, for M1 and M3."""
    return days.join(places_of(stores).select("store_id", "place", "store_size"), "store_id").select(
        "place", "store_size", "is_rain", "temp_max", "temp_min", "date", "invoice_no", "lines", "totals",
        F.col("revenue").cast("bigint").alias("revenue"))


def region_impact_by_place(matched: DataFrame, stores: DataFrame, strict: bool = False) -> DataFrame:
    """M1 from ``matched_days``. What is exchanged is whole numbers: a place for
    its country, city and size, temperatures in hundredths, totals in units; the
    distinct count is spread by invoice, as in ``region_impact_from``."""
    cols = (S.STRICT_MARTS if strict else S.TABLES)[M1]
    rows = matched.select(
        "place", "is_rain", "date", "invoice_no", "revenue",
        *[x for t in ("temp_max", "temp_min") for x in (
            ((F.col(t) * 100).cast("bigint") * F.col("lines")).alias(t),
            F.when(F.col(t).isNotNull(), F.col("lines")).otherwise(0).alias(f"{t}_lines"))])
    g = rows.groupBy("place", "is_rain", day_trunc("date").alias("sale_date")).agg(
        F.count_distinct("invoice_no").alias("transaction_count"), F.sum("revenue").cast("decimal(20,0)").alias("total_revenue"),
        *[exact_ratio(F.sum(t).cast("decimal(20,0)") / 100, F.sum(f"{t}_lines"), "decimal(5,2)").alias(f"avg_{t}")
          for t in ("temp_max", "temp_min")])
    named = places_of(stores).where("store_id = place").select("place", "country", "city", "store_size")
    return conform(g.join(named, "place"), cols, M1)


def size_months(region: DataFrame, month: Column) -> DataFrame:
    """Matched invoice days -> sums and invoice sets, by month. Bitmaps are
    reduced by a sort; a hash of the keys leads them, so that it seldom has to
    compare their texts."""
    no = F.col("invoice_no")
    keys = {"month": month, "store_size": F.col("store_size"), "is_rain": F.col("is_rain"),
            "temperature_range": temperature_range("temp_max"), "bucket": F.bitmap_bucket_number(no)}
    return region.groupBy(F.xxhash64(*keys.values()).alias("_lead"), *[c.alias(k) for k, c in keys.items()]).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("invoices"),
        F.sum("totals").alias("totals"), F.sum("revenue").cast("decimal(30,0)").alias("revenue")).drop("_lead")


def product_months(lines: DataFrame, month: Column) -> DataFrame:
    """Product days with weather -> sums, by month."""
    return lines.groupBy(month, "product_id", "is_rain", temperature_range("temp_max").alias("temperature_range")).agg(
        F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"),
        F.sum("amount").cast("decimal(38,4)").alias("amount"))


# ---------------------------------------------------------------- merged
def distinct_invoices(sets: DataFrame, keys: list[str]) -> DataFrame:
    """A2 from invoice sets: exact COUNT(DISTINCT) per group, as
    ``transaction_count``. The sets of one bucket are or-ed, map-side first."""
    buckets = sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("invoices").alias("invoices"))
    return buckets.groupBy(*keys).agg(F.sum(F.bitmap_count("invoices")).alias("transaction_count"))


def size_impact_merged(months: DataFrame, strict: bool = False) -> DataFrame:
    """M3 from ``size_months`` of all months."""
    cols = (S.STRICT_MARTS if strict else S.TABLES)[M3]
    money = next(c.type for c in cols if c.name == "avg_transaction_value")
    keys = ["store_size", "is_rain", "temperature_range"]
    buckets = months.groupBy(*keys, "bucket").agg(
        F.bitmap_or_agg("invoices").alias("invoices"), F.sum("totals").alias("totals"), F.sum("revenue").alias("revenue"))
    g = buckets.groupBy(*keys).agg(
        F.sum(F.bitmap_count("invoices")).alias("transaction_count"),
        exact_ratio(F.sum("revenue").cast("decimal(28,0)"), F.sum("totals"), money).alias("avg_transaction_value"),
        F.sum("revenue").alias("total_revenue"))
    return conform(g, cols, M3)


def product_sensitivity_merged(months: DataFrame, products: DataFrame, strict: bool = False) -> DataFrame:
    """M2 from ``product_months`` of all months; the product's attributes are
    joined to the merged rows."""
    g = months.groupBy("product_id", "is_rain", "temperature_range").agg(
        F.sum("lines").alias("transaction_count"), F.sum("quantity").alias("total_quantity"),
        F.sum("amount").alias("total_revenue"))
    return conform(join_product(g, products), (S.STRICT_MARTS if strict else S.TABLES)[M2], M2)
