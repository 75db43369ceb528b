"""Variable-capacity best-fit packing of documents into training sequences.

Operator 10. Documents are measured in words, those longer than the largest
permitted length are cut into pieces of that length, and pieces are packed
best-fit decreasing: each goes to the open bin with the least room that still
holds it, else a bin is opened. Which length to open is optimised jointly: a
shard is packed once under each opening preference (open the least-cost length
per token that can still be filled; or a given permitted length, longer ones
only for pieces that need them), every bin is then downsized to the smallest
permitted length that holds its contents, and the cheapest result is kept.
Cost of a sequence: its length plus a fixed cost.

Pieces are dealt by hash into shards of about ``shard_rows`` that are packed
independently, so neither a task nor the driver sees more than a shard at a
time (one of more than twice that many rows is packed in runs of that size).
Only ids and lengths are exchanged, never texts.

Defined results: a null, empty or blank text has no words and gives one row
with a null bin; texts of any length are cut into pieces; equal lengths are
ordered by id, then by text hash; repeated rows are packed each by itself, and
the copies of a row that stands very often are dealt over many shards (which of
them goes where makes no difference but for the names of the bins); an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raincheck.llm import common as C

SIZES = (512, 1024, 2048, 4096)
FIXED_COST = 32
SHARD_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def _open_size(length: int, remaining: int, sizes: Sequence[int], fixed: int, preferred: int | None) -> int:
    fitting = [s for s in sizes if s >= length]
    if preferred is not None:
        return max(preferred, fitting[0])
    return min(fitting, key=lambda s: ((s + fixed) / min(s, remaining), s))


def pack_once(lengths: Sequence[int], sizes: Sequence[int], fixed: int, preferred: int | None):
    """Best fit over lengths in the given order: bin and offset of each, bin sizes, cost."""
    room: dict[int, list[int]] = {}          # free space -> open bins, the oldest last
    spaces: list[int] = []                   # its keys, sorted
    used: list[int] = []
    capacity: list[int] = []
    bins, offsets = [], []
    remaining = sum(lengths)
    for length in lengths:
        i = bisect_left(spaces, length)
        if i < len(spaces):
            space = spaces[i]
            b = room[space].pop()
            if not room[space]:
                del room[space], spaces[i]
        else:
            b = len(used)
            space = _open_size(length, remaining, sizes, fixed, preferred)
            used.append(0)
            capacity.append(space)
        bins.append(b)
        offsets.append(used[b])
        used[b] += length
        remaining -= length
        left = space - length
        if left:
            if left not in room:
                room[left] = []
                insort(spaces, left)
            room[left].append(b)
    final = [sizes[bisect_left(sizes, u)] for u in used]
    return bins, offsets, final, sum(final) + fixed * len(final)


def pack(lengths: Sequence[int], sizes: Sequence[int] = SIZES, fixed: int = FIXED_COST):
    """The cheapest of the packings over all opening preferences (ties: the first)."""
    sizes = sorted(sizes)
    return min((pack_once(lengths, sizes, fixed, p) for p in (None, *reversed(sizes))), key=lambda r: r[3])


def pack_documents(docs: DataFrame, sizes: Sequence[int] = SIZES, fixed: int = FIXED_COST,
                   shard_rows: int = SHARD_ROWS, n_tokens=None) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bin_id, bin_size, bin_offset."""
    largest = max(sizes)
    n = F.regexp_count("text", F.lit(WORD)) if n_tokens is None else n_tokens
    rows = docs.select("doc_id", C.doc_key().alias("d"), C.row_key().alias("th"),
                       F.coalesce(n, F.lit(0)).cast("bigint").alias("n"))
    pieces = F.greatest(F.ceil(F.col("n") / largest), F.lit(1)).cast("int")
    rows = rows.select("doc_id", "d", "th", "n", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    start = F.col("piece").cast("bigint") * largest
    rows = rows.select("doc_id", "d", "th", "piece", start.alias("start"),
                       F.least(F.col("n") - start, F.lit(largest)).alias("n_tokens"))
    rows = C.stored(rows, "pieces")                       # ids and lengths only
    shards = max(1, -(-rows.count() // shard_rows))
    rows = spread_copies(rows, max(1, shard_rows // 10))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("d", "th", "piece", "salt"), F.lit(shards)).cast("bigint"))
    rows = rows.repartition("shard").sortWithinPartitions(
        "shard", F.desc("n_tokens"), "d", "th", "piece")
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("bin_id", T.StringType()), T.StructField("bin_size", T.IntegerType()),
        T.StructField("bin_offset", T.LongType())])
    return rows.select("doc_id", "piece", "start", "n_tokens", "shard").mapInArrow(
        _packer(tuple(sizes), fixed, 2 * shard_rows), schema)


def spread_copies(rows: DataFrame, most: int) -> DataFrame:
    """Adds ``salt``, which deals the copies of a row that stands more than
    ``most`` times over as many shards as they need; 0 for all others. ``rows``
    is a written table: a copy is told from another by its place in the files,
    which stays the same however often it is read."""
    key = ["d", "th", "piece"]
    many = C.stored(rows.groupBy(*key).count().where(F.col("count") > most), "copies")
    if many.isEmpty():
        return rows.withColumn("salt", F.lit(0))
    placed = rows.select("*", F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("place"))
    spread = many.select(*key, F.ceil(F.col("count") / most).alias("spread"))
    return placed.join(spread, key, "left").withColumn(
        "salt", F.pmod("place", F.coalesce("spread", F.lit(1))).cast("int")).drop("place", "spread")


def _packer(sizes, fixed, most):
    def finish(parts: list[pa.RecordBatch], shard: int, run: int) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks()
        n = whole.column("n_tokens").to_numpy()
        some = int(np.count_nonzero(n))                  # rows of no words come last
        bins, offsets, final, _ = pack(n[:some].tolist(), sizes, fixed)
        gap = [None] * (len(n) - some)
        out = [*(whole.column(c).combine_chunks() for c in ("doc_id", "piece", "start", "n_tokens")),
               pa.array([f"{shard}-{run}-{b}" for b in bins] + gap, pa.string()),
               pa.array([final[b] for b in bins] + gap, pa.int32()), pa.array(offsets + gap, pa.int64())]
        out = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in out]
        return pa.RecordBatch.from_arrays(
            out, ["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_size", "bin_offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, shard, runs = [], 0, None, 0
        for batch in batches:
            ids = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for i, j in zip(cuts, cuts[1:]):
                while i < j:
                    if parts and (ids[i] != shard or rows >= most):
                        yield finish(parts, shard, runs)
                        runs = runs + 1 if ids[i] == shard else 0
                        parts, rows = [], 0
                    elif ids[i] != shard:
                        runs = 0
                    shard, take = int(ids[i]), min(j - i, most - rows)
                    parts.append(batch.slice(i, take))
                    rows, i = rows + take, i + take
        if parts:
            yield finish(parts, shard, runs)
    return run


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(C.table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs.select("doc_id", "text"))
