"""Candidate search that the two repeat operators share.

A repeated stretch of W units (words or bytes) is found through an anchor: a
mark inside the stretch that depends on its content only, so equal stretches
have equal anchors at equal places. Consecutive windows with the same anchor
form a segment. ``Segments`` holds those of a block of documents: ``key``
(hash of the anchor), ``h`` (hash of the segment's whole content), row, start
and number of windows.

``marks`` decides, for all segments at once, which can hold a repeat:

* ``removed``: an equal segment starts earlier, so every window in it does;
* ``check``: another segment with the same anchor exists, so single windows
  may repeat and have to be compared;
* no mark: the anchor occurs once in all the data, so no window repeats.

Within one map task equal segments are merged to their first, and a key that
already has several contents there is marked without asking; the exchange then
carries, of any key, at most one row and one marker per task and flush,
however many rows share it. Rows travel packed, by bucket of the key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck.llm import common as C

ROW = np.dtype([("key", "<u8"), ("h", "<u8"), ("d", "<i8"), ("tag", "<i4"), ("start", "<i8"), ("n", "<i4"),
                ("kind", "<i1")])
ASK, TELL, REMOVED, CHECK = 0, 1, 2, 3
#: Segments that a map task gathers before it sends them on.
FLUSH = 400_000
#: Text bytes of a numpy pass. Its arrays take about a hundred times as much, in every Python worker of an executor.
PASS_BYTES = 1 << 18

MARKS = "key bigint, d bigint, tag int, start bigint, n int, removed boolean"


def tag_of(th: np.ndarray) -> np.ndarray:
    """Tells texts of one doc_id apart."""
    return th.astype(np.int64).astype(np.int32)


def _order(rows: np.ndarray) -> np.ndarray:
    """Rows by key, content, document and start; most keys have one row, and need no more than the first."""
    key = np.ascontiguousarray(rows["key"])
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    tied = np.zeros(len(rows), bool)
    tied[1:] = same
    tied[:-1] |= same
    among = order[tied]
    few = rows[among]
    order[tied] = among[np.lexsort((few["start"], few["d"], few["h"], few["key"]))]
    return rows[order]


def _same_key(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), bool)
    out[1:] = rows["key"][1:] == rows["key"][:-1]
    return out


def _later(rows: np.ndarray, same_key: np.ndarray) -> np.ndarray:
    """Rows (in order) with an equal segment that starts earlier."""
    new = np.ones(len(rows), bool)
    new[1:] = ~same_key[1:] | (rows["h"][1:] != rows["h"][:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
    return (rows["d"] != rows["d"][first]) | (rows["start"] != rows["start"][first])


def local_marks(rows: np.ndarray) -> np.ndarray:
    """What one task can tell, and what it has to ask."""
    rows = _order(rows)
    same = _same_key(rows)
    later = _later(rows, same)
    rows["kind"] = np.where(later, REMOVED, ASK)
    kept = rows[~later]
    # A key with several first segments here: all are to be checked.
    same = _same_key(kept)
    several = same.copy()
    several[:-1] |= same[1:]
    kept["kind"][several] = CHECK
    tell = kept[several & ~same].copy()
    tell["kind"] = TELL
    return np.concatenate((rows[later], kept, tell))


def global_marks(rows: np.ndarray) -> np.ndarray:
    """Marks for the asking rows of whole keys."""
    rows = _order(rows)
    told = rows["kind"] == TELL
    told_keys = np.unique(rows["key"][told])
    rows = rows[~told]
    same = _same_key(rows)
    later = _later(rows, same)
    rows["kind"] = REMOVED
    kept = rows[~later].copy()
    same = _same_key(kept)
    several = same.copy()
    several[:-1] |= same[1:]
    several |= np.isin(kept["key"], told_keys)
    kept["kind"] = CHECK
    return np.concatenate((rows[later], kept[several]))


def anywhere(d: np.ndarray, start: np.ndarray, buckets: int) -> np.ndarray:
    """An even bucket for rows that need not meet others, from document and place."""
    mixed = C.mix(C.mix(d.astype(np.int64).view(np.uint64)) ^ start.astype(np.int64).view(np.uint64))
    return (mixed % np.uint64(buckets)).astype(np.int64)


def _send(rows: np.ndarray, buckets: int) -> pa.RecordBatch:
    rows = local_marks(rows)
    asks = rows["kind"] <= TELL
    bucket = (C.mix(rows["key"]) % np.uint64(buckets)).astype(np.int64)
    # What is settled needs no meeting: spread it evenly, whatever the ids and however many rows share one.
    bucket[~asks] = anywhere(rows["d"][~asks], rows["start"][~asks], buckets)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts[:-1]], pa.int64()),
         pa.array([rows[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())], ["bucket", "rows"])


def marks(docs: DataFrame, segments: Callable[[np.ndarray, np.ndarray], tuple], width: int,
          pass_bytes: int = PASS_BYTES) -> DataFrame:
    """key, d, tag, start, n, removed for every segment that can hold a repeat.

    ``docs`` has d, th, text; ``segments(data, offsets)`` gives the arrays
    (row, start, n, key, h) of a block of about ``pass_bytes``.
    """
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            d = batch.column(0).to_numpy()
            tag = tag_of(batch.column(1).to_numpy())
            data, offsets = C.text_bytes(batch.column(2))
            for i, j in C.blocks(offsets, pass_bytes):
                row, start, n, key, h = segments(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                rows = np.zeros(len(row), ROW)
                rows["key"], rows["h"], rows["start"], rows["n"] = key, h, start, n
                rows["d"], rows["tag"] = d[i:j][row], tag[i:j][row]
                held.append(rows)
                size += len(rows)
                if size >= FLUSH:
                    yield _send(np.concatenate(held), buckets)
                    held, size = [], 0
        if size:
            yield _send(np.concatenate(held), buckets)

    def settle(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = np.frombuffer(b"".join(parts), ROW)
        done = rows["kind"] >= REMOVED
        out = np.concatenate((rows[done], global_marks(rows[~done])))
        for i in range(0, len(out), 100_000):
            part = out[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(C.signed(part["key"])), pa.array(part["d"].astype(np.int64)), pa.array(part["tag"].astype(np.int32)),
                 pa.array(part["start"].astype(np.int64)), pa.array(part["n"].astype(np.int32)),
                 pa.array(part["kind"] == REMOVED)], ["key", "d", "tag", "start", "n", "removed"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bucket = [], None
        for batch in batches:
            for b, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                if b != bucket and parts:
                    yield from settle(parts)
                    parts = []
                bucket = b
                parts.append(rows.as_py())
        if parts:
            yield from settle(parts)

    sent = docs.select("d", "th", "text").mapInArrow(cut, "bucket bigint, rows binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, MARKS)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, d, th, tag, text of the documents."""
    th = C.row_key()
    tag = F.shiftright(F.shiftleft(th, 32), 32).cast("int")
    return docs.select("doc_id", C.doc_key().alias("d"), th.alias("th"), tag.alias("tag"), "text")


def covered(starts: np.ndarray, counts: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of ``length`` units lie in a window that starts in one of the ranges."""
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + counts - 1 + width, length), -1)
    return np.cumsum(edge[:-1]) > 0
