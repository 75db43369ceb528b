"""Missing-value tokens of a CSV loader that infers types.

Spark's CSV reader knows one ``nullValue``; a pandas-style loader treats a
whole set of spellings as missing. Cells are read as text, these tokens are
mapped to NULL, and only then are columns cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default missing-value spellings of pandas.read_csv.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def null_if_token(c, tokens=None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isin(tokens or NULL_TOKENS), F.lit(None)).otherwise(col)


def clean_null_tokens(df: DataFrame, tokens=None) -> DataFrame:
    """Map every string column's missing-value tokens to NULL."""
    return df.select([
        null_if_token(F.col(f"`{f.name}`"), tokens).alias(f.name)
        if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
