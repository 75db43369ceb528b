"""Column -> Column helpers; all built from pyspark.sql.functions (no UDFs)."""

from raincheck.functions.dates import (date_parts, day_name, day_of_week, day_offset, day_trunc,
                                       month_name)
from raincheck.functions.numeric import exact_avg, exact_ratio, exact_sum, micro_sum
from raincheck.functions.nulls import NULL_TOKENS, null_if_token
from raincheck.functions.weather import (rain_flag, store_size_tier, temperature_range,
                                         weather_label)

__all__ = [
    "date_parts", "day_name", "day_of_week", "day_offset", "day_trunc", "month_name",
    "exact_avg", "exact_sum", "micro_sum", "exact_ratio", "NULL_TOKENS", "null_if_token", "rain_flag",
    "store_size_tier", "temperature_range", "weather_label",
]
