"""Exact numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_avg(c, out_type: str) -> Column:
    """AVG of an exact numeric, rounded half-up once into ``out_type``.

    The mean is taken over a widened decimal (14 fractional digits) so the
    final rounding is decided by the exact value, not by a double.
    """
    return F.avg(_c(c).cast("decimal(28,10)")).cast(out_type)


def exact_sum(c, in_type: str = "decimal(18,4)") -> Column:
    """Order-independent SUM of a double column known to hold ``in_type`` values."""
    return F.sum(_c(c).cast(in_type))


def exact_ratio(total: Column, n: Column, out_type: str) -> Column:
    """total / n of exact numerics, rounded half-up once into ``out_type``
    (NULL when n is 0): the mean of values summed and counted before."""
    return (total.cast("decimal(28,10)") / F.nullif(n, F.lit(0)).cast("decimal(20,0)")).cast(out_type)


def micro_sum(c, digits: int = 6) -> Column:
    """Order-independent SUM of an arbitrary double column, as DOUBLE.

    Each value is rounded to ``digits`` decimals with floor(x * 10^d + 0.5)
    (plain IEEE arithmetic, the same in every engine), the integers are
    summed exactly, and the total is scaled back once. A plain double SUM
    would depend on the order in which partitions are combined.
    """
    m = float(10 ** digits)
    return F.sum(F.floor(_c(c) * F.lit(m) + F.lit(0.5))).cast("double") / F.lit(m)
