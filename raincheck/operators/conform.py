"""Assignment to a target table: cast, length and not-null checks (P10).

A relational INSERT converts each value to the column type and rejects the
whole statement on a bad value. Here every value goes through an ANSI cast
(a bad cast fails the job), over-long text and NULL in a NOT NULL column
raise, and the result has exactly the target columns, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raincheck.schemas import Col

_INTEGRAL = ("int", "bigint")


def cast_to(src: Column, src_type: T.DataType, target: str) -> Column:
    """ANSI cast of one value to the target type.

    Integer columns read as text may hold a float spelling ("7.0") when the
    file had missing values; such text is parsed as a decimal and rounded to
    the nearest integer (ties to even), as a float-to-integer assignment does.
    """
    if target in _INTEGRAL and isinstance(src_type, T.StringType):
        return F.bround(src.cast("decimal(38,9)"), 0).cast(target)
    if target in _INTEGRAL and isinstance(src_type, (T.DoubleType, T.FloatType)):
        return F.bround(src, 0).cast(target)
    return src.cast(target)


def checked(v: Column, col: Col, table: str) -> Column:
    if col.max_len is not None:
        v = F.when(F.length(v) > col.max_len, F.raise_error(F.concat(
            F.lit(f"value too long for {table}.{col.name} varchar({col.max_len}): "), v))
        ).otherwise(v)
    if col.not_null:
        v = F.when(v.isNull(), F.raise_error(F.lit(
            f"null value in column {col.name} of {table} violates not-null"))).otherwise(v)
    return v


def conform(df: DataFrame, cols: list[Col], table: str = "table", keep=()) -> DataFrame:
    """Project ``df`` onto the target columns with target types and checks.

    ``keep`` names extra columns passed through unchanged after the targets.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in cols:
        if c.name not in types:
            raise ValueError(f"{table}: missing column {c.name!r}")
        v = cast_to(F.col(f"`{c.name}`"), types[c.name], c.type)
        out.append(checked(v, c, table).alias(c.name))
    return df.select(*out, *[F.col(f"`{k}`") for k in keep])
