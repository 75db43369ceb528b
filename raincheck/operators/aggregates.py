"""Named aggregations (A1-A8) used by the marts, reports and checks.

All are single ``groupBy().agg()`` plans: Spark aggregates partially on the
map side, so a hot key is reduced before the shuffle. Distinct counts are
exact (``count_distinct``), never approximate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck.functions.numeric import exact_avg, exact_sum
from raincheck.functions.weather import temperature_range


def invoice_counts(lines: DataFrame, keys) -> DataFrame:
    """A2: COUNT(DISTINCT invoice_id) per group."""
    return lines.groupBy(*keys).agg(F.count_distinct("invoice_id").alias("transaction_count"))


def line_counts(lines: DataFrame, keys) -> DataFrame:
    """A3: COUNT(invoice_id) per group (lines with a non-NULL invoice)."""
    return lines.groupBy(*keys).agg(F.count("invoice_id").alias("transaction_count"))


def line_sums(lines: DataFrame, keys) -> DataFrame:
    """A4: sums of invoice total (per line), quantity and line total."""
    return lines.groupBy(*keys).agg(
        F.sum("invoice_total").alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
        exact_sum("line_total").alias("line_revenue"))


def temperature_averages(weather: DataFrame, keys) -> DataFrame:
    """A5: exact means of temp_max / temp_min (NULLs skipped), 2 decimals."""
    return weather.groupBy(*keys).agg(
        exact_avg("temp_max", "decimal(5,2)").alias("avg_temp_max"),
        exact_avg("temp_min", "decimal(5,2)").alias("avg_temp_min"))


def days_by_temperature_range(weather: DataFrame) -> DataFrame:
    """Grouping by a CASE expression (rain flag x temperature range)."""
    return weather.groupBy("is_rain", temperature_range("temp_max").alias("temperature_range")).agg(
        F.count(F.lit(1)).alias("store_days"))
