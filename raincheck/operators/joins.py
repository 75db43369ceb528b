"""Joins of the invoice lines with the store, weather and product dimensions.

Every join is an inner equi-join; NULL keys never match. No join strategy is
forced: written tables have file sizes for the planner, and for derived frames
adaptive execution decides on measured bytes
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), splitting skewed
partitions of a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_store(lines: DataFrame, stores: DataFrame, cols=("country", "city", "size")) -> DataFrame:
    """Lines ⋈ stores on store_id; the store's ``size`` becomes ``store_size``."""
    s = stores.select("store_id", *[F.col(c).alias("store_size") if c == "size" else F.col(c)
                                    for c in cols])
    return lines.join(s, "store_id")


def _weather_side(weather: DataFrame, cols, extra=()) -> DataFrame:
    return weather.select("store_id", F.col("date_id").alias("date"), *cols, *extra)


def join_weather(lines: DataFrame, weather: DataFrame,
                 cols=("temp_max", "temp_min", "is_rain")) -> DataFrame:
    """Lines ⋈ weather on (store_id, date = date_id); lines without weather drop out.

    A hot store spreads over its days; adaptive execution splits a hot
    store-day.
    """
    return lines.join(_weather_side(weather, cols), ["store_id", "date"])


def join_product(lines: DataFrame, products: DataFrame,
                 cols=("category", "sub_category")) -> DataFrame:
    """Lines ⋈ products on product_id."""
    return lines.join(products.select("product_id", *cols), "product_id")


def join_weather_audited(lines: DataFrame, weather: DataFrame, audit,
                         cols=("temp_max", "temp_min", "is_rain"), weight: str | None = None) -> DataFrame:
    """J2 with an audit of the lines it drops (R6), in the same join.

    A left join marks lines that found a weather row; an observation counts
    the others (``unmatched_lines``) while the plan runs; then only matched
    lines continue, so the result equals ``join_weather``. ``weight`` names a
    column with the number of lines that a row stands for.
    """
    n = F.col(weight) if weight else F.lit(1)
    w = _weather_side(weather, cols, [F.lit(True).alias("_has_weather")])
    j = lines.join(w, ["store_id", "date"], "left")
    j = j.observe(audit, F.coalesce(F.sum(n), F.lit(0)).alias("lines"),
                  F.coalesce(F.sum(F.when(F.col("_has_weather").isNull(), n)), F.lit(0)).alias("unmatched_lines"))
    return j.filter(F.col("_has_weather")).drop("_has_weather")
