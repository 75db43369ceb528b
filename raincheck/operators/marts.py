"""The three data marts (M1-M3) over fact ⋈ weather ⋈ store / product.

Each mart reads only the fact columns it needs. The fact is joined with
weather first, on store_id and date, then with the stores. The exact distinct
count of M1 and M3 groups by invoice below the mart's groups, and its partial
aggregate reduces the lines in the join's tasks: one hash table there, and no
reduction to invoice days before it, which would hold two more of the same rows.
Money is summed exactly (decimal), averages are exact and rounded once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck import schemas as S
from raincheck.functions.dates import day_trunc
from raincheck.functions.numeric import exact_ratio, exact_sum
from raincheck.functions.weather import temperature_range
from raincheck.operators.conform import conform
from raincheck.operators.joins import join_product, join_store, join_weather

M1 = "data_mart_weather_region_impact"
M2 = "data_mart_product_weather_sensitivity"
M3 = "data_mart_store_size_weather_impact"


def _cols(table: str, strict: bool):
    return (S.STRICT_MARTS if strict else S.TABLES)[table]


def invoice_days(weather_lines: DataFrame) -> DataFrame:
    """Lines with weather -> one row per store, day, weather and invoice:
    ``lines``, ``totals`` (non-NULL invoice totals), ``revenue`` (their sum)."""
    return weather_lines.groupBy(
        "store_id", "date", "is_rain", "temp_max", "temp_min", "invoice_id",
    ).agg(F.count(F.lit(1)).alias("lines"), F.count("invoice_total").alias("totals"),
          F.sum("invoice_total").alias("revenue"))


def as_days(weather_lines: DataFrame) -> DataFrame:
    """Lines with weather in the columns of ``invoice_days``, one row each."""
    return weather_lines.select(
        "store_id", "date", "is_rain", "temp_max", "temp_min", "invoice_id", F.lit(1).cast("bigint").alias("lines"),
        F.when(F.col("invoice_total").isNotNull(), 1).otherwise(0).cast("bigint").alias("totals"),
        F.col("invoice_total").alias("revenue"))


def region_days(fact: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """Lines as invoice days with store attributes, for M1 and M3."""
    lines = fact.select("invoice_id", "store_id", "date", "invoice_total")
    return join_store(as_days(join_weather(lines, weather)), stores)


def product_lines(fact: DataFrame, products: DataFrame, weather: DataFrame) -> DataFrame:
    """Lines with weather and product attributes, for M2."""
    lines = fact.select("invoice_id", "product_id", "store_id", "date", "quantity", "line_total")
    return join_product(join_weather(lines, weather, cols=("temp_max", "is_rain")), products)


def _weighted(temperature: str):
    """Sum over lines, and number of lines, of a temperature that is one per row."""
    value = F.col(temperature).cast("decimal(15,2)") * F.col("lines").cast("decimal(10,0)")
    return F.sum(value), F.sum(F.when(F.col(temperature).isNotNull(), F.col("lines")).otherwise(0))


def region_impact_from(days: DataFrame, strict: bool = False, invoice: str = "invoice_id") -> DataFrame:
    """M1 from ``region_days``: one row per country, city, size, rain, day.

    ``total_revenue`` adds the invoice total once per line, as the source does.
    ``invoice`` names the column that tells invoices apart.
    """
    cols = _cols(M1, strict)
    g = days.groupBy(
        "country", "city", "store_size", "is_rain", day_trunc("date").alias("sale_date"),
    ).agg(
        F.count_distinct(invoice).alias("transaction_count"),
        F.sum("revenue").alias("total_revenue"),
        exact_ratio(*_weighted("temp_max"), "decimal(5,2)").alias("avg_temp_max"),
        exact_ratio(*_weighted("temp_min"), "decimal(5,2)").alias("avg_temp_min"),
    )
    return conform(g, cols, M1)


def product_sensitivity_from(lines: DataFrame, strict: bool = False) -> DataFrame:
    """M2 from ``product_lines``: line counts, quantity and line revenue."""
    cols = _cols(M2, strict)
    g = lines.groupBy(
        "product_id", "category", "sub_category", "is_rain",
        temperature_range("temp_max").alias("temperature_range"),
    ).agg(
        F.count("invoice_id").alias("transaction_count"),
        F.sum("quantity").alias("total_quantity"),
        exact_sum("line_total").alias("total_revenue"),
    )
    return conform(g, cols, M2)


def size_impact_from(days: DataFrame, strict: bool = False) -> DataFrame:
    """M3 from ``region_days``: per size, rain and temperature range."""
    cols = _cols(M3, strict)
    money = [c.type for c in cols if c.name == "avg_transaction_value"][0]
    g = days.groupBy(
        "store_size", "is_rain", temperature_range("temp_max").alias("temperature_range"),
    ).agg(
        F.count_distinct("invoice_id").alias("transaction_count"),
        exact_ratio(F.sum("revenue"), F.sum("totals"), money).alias("avg_transaction_value"),
        F.sum("revenue").alias("total_revenue"),
    )
    return conform(g, cols, M3)


def region_impact(fact, stores, weather, strict: bool = False) -> DataFrame:
    """M1."""
    return region_impact_from(region_days(fact, stores, weather), strict)


def product_sensitivity(fact, products, weather, strict: bool = False) -> DataFrame:
    """M2."""
    return product_sensitivity_from(product_lines(fact, products, weather), strict)


def size_impact(fact, stores, weather, strict: bool = False) -> DataFrame:
    """M3."""
    return size_impact_from(region_days(fact, stores, weather), strict)
