"""Weather and store classifications (CASE expressions).

In every CASE the final ELSE also receives NULL input, as in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels of the classifications.
RAIN_THRESHOLD_MM = 1.0          # rain means precipitation strictly above this
COLD_BELOW = 10                  # temp_max < 10 -> cold
MODERATE_UPTO = 25               # 10 <= temp_max <= 25 -> moderate, else hot
SMALL_UPTO = 7                   # employees <= 7 -> Small
MEDIUM_BELOW = 10                # employees < 10 -> Medium, else Large
RAINY, NOT_RAINY = "Rainy", "Not Rainy"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rain_flag(precipitation) -> Column:
    """precipitation > 1.0 mm; a missing value counts as no rain."""
    return F.coalesce(_c(precipitation) > F.lit(RAIN_THRESHOLD_MM), F.lit(False))


def temperature_range(temp_max) -> Column:
    t = _c(temp_max)
    return (F.when(t < COLD_BELOW, F.lit("cold"))
             .when(t.between(COLD_BELOW, MODERATE_UPTO), F.lit("moderate"))
             .otherwise(F.lit("hot")))


def weather_label(is_rain) -> Column:
    return F.when(_c(is_rain), F.lit(RAINY)).otherwise(F.lit(NOT_RAINY))


def store_size_tier(number_of_employees) -> Column:
    n = _c(number_of_employees)
    return (F.when(n <= SMALL_UPTO, F.lit("Small"))
             .when(n < MEDIUM_BELOW, F.lit("Medium"))
             .otherwise(F.lit("Large")))
