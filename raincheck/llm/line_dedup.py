"""Line dedup: repeated windows of three consecutive lines.

Operator 1. Every three consecutive lines of a document are hashed (128 bits);
a window whose lines also start earlier (smaller doc_id, or the same document
further up) is a later occurrence, and the lines that later occurrences cover,
merged, are removed. Windows are judged on the input.

First places are found by a grouped minimum, which combines map-side, and only
windows that occur more than once come back to the documents, through joins
that adaptive execution splits when a window is hot.

Defined results: lines are what stands between line feeds, taken verbatim;
texts of fewer than three lines (null and empty ones too) have no window and
stay as they are, null as null; a null doc_id is before all others; rows that
share a doc_id are judged alike and none of them is earlier; a text that loses
every line becomes empty; an empty table gives no rows; other columns are
carried along unchanged, under any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck.llm import common as C

LINES = 3


def _hashed(lines: str, i, width: int, *seed):
    return F.xxhash64(*seed, *[F.get(F.col(lines), i + j if j else i) for j in range(width)])


def line_windows(docs: DataFrame, width: int = LINES) -> DataFrame:
    """d, th, pos, a, b: one row per window of consecutive lines."""
    rows = docs.select(C.doc_key().alias("d"), C.row_key().alias("th"), F.split("text", "\n").alias("l"))
    rows = rows.where(F.size("l") >= width)
    rows = rows.select("d", "th", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("l") - width), lambda i: F.struct(
            i.alias("pos"), _hashed("l", i, width).alias("a"),
            _hashed("l", i, width, F.lit(width)).alias("b")))).alias("w"))
    return rows.select("d", "th", "w.pos", "w.a", "w.b")


def removed_lines(docs: DataFrame, width: int = LINES) -> DataFrame:
    """d, th, starts: the windows of each row that occur earlier."""
    windows = line_windows(docs, width)
    firsts = C.stored(
        windows.groupBy("a", "b").agg(F.min(F.struct("d", "pos")).alias("first"), F.max(F.struct("d", "pos")).alias("last"))
        .where(F.col("first") < F.col("last")).select("a", "b", "first"), "first-lines")
    later = windows.join(firsts, ["a", "b"]).where(F.struct("d", "pos") > F.col("first"))
    return later.groupBy("d", "th").agg(F.collect_set("pos").alias("starts"))


def dedup_lines(docs: DataFrame, width: int = LINES, extra: bool = False) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; with ``extra``
    also ``__n_lines`` and ``__n_removed``."""
    hits = C.stored(removed_lines(docs, width), "line-hits").select(
        F.col("d").alias("__d"), F.col("th").alias("__th"), F.col("starts").alias("__starts"))
    rows = docs.withColumn("__d", C.doc_key()).withColumn("__th", C.row_key())
    rows = C.by_key(rows, hits, ["__d", "__th"], "left")
    rows = rows.withColumn("__l", F.split("text", "\n"))
    n = F.size("__l")
    covered = F.flatten(F.transform("__starts", lambda p: F.sequence(p, p + (width - 1))))
    rows = rows.withColumn("__kept", F.when(F.col("__starts").isNotNull(), F.array_except(
        F.sequence(F.lit(0), n - 1), covered)))
    text = F.when(F.col("__starts").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("__kept", lambda i: F.get(F.col("__l"), i)), "\n"))
    more = [F.when(F.col("text").isNull(), 0).otherwise(n).cast("bigint").alias("__n_lines"),
            F.when(F.col("__starts").isNull(), 0).otherwise(n - F.size("__kept")).cast("bigint").alias("__n_removed")]
    return rows.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns], *(more if extra else []))


def query(spark, sf_dir: str) -> DataFrame:
    docs = dedup_lines(C.table(spark, sf_dir, "documents").select("doc_id", "text"), extra=True)
    return docs.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs)


ORACLE = """
WITH l AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(lines[p:p + 2], chr(10)) AS s
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS p FROM l WHERE len(lines) >= 3)
), later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
), covered AS (
  SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(p, p + 3)) AS k FROM later) GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
  CASE WHEN ks IS NULL THEN text ELSE coalesce(array_to_string(
    [lines[i] FOR i IN range(1, len(lines) + 1) IF NOT list_contains(ks, i)], chr(10)), '') END AS text
FROM l LEFT JOIN covered USING (doc_id)
"""
