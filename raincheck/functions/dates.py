"""Date helpers: day truncation, day offsets and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_trunc(c) -> Column:
    """Truncate to the day and keep a DATE (identity on a DATE column)."""
    return F.to_date(_c(c))


def day_offset(c, days: int = 1, fmt: str = "yyyy-MM-dd") -> Column:
    """(date - days) formatted as text, e.g. the weather file name."""
    return F.date_format(F.date_sub(_c(c), days), fmt)


def month_name(c) -> Column:
    """Full English month name, unpadded (Spark formats with an English locale)."""
    return F.date_format(_c(c), "MMMM")


def day_name(c) -> Column:
    return F.date_format(_c(c), "EEEE")


def day_of_week(c) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(c)) - 1


def date_parts(c) -> list[Column]:
    """The calendar columns of the date dimension, in table order."""
    d = _c(c)
    return [
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        month_name(d).alias("month_name"), F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"), day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
    ]
