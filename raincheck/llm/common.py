"""Helpers shared by the operators of this package.

Document order and identity
---------------------------
Operators that speak of an "earlier" document order rows by ``doc_key``: the
integer id, with a null id before every other. Rows that share an id are one
document as far as order goes, so neither is earlier than the other;
``row_key`` tells rows of one id with different texts apart. Equal rows get
equal results.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raincheck.session import scratch_path

NULL_KEY = -(1 << 63)
#: Text bytes that one numpy pass handles; a longer text is a pass of its own.
BLOCK_BYTES = 1 << 20


def ready(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package, whatever their
    working folder; on a cluster the package comes with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NULL_KEY))


def row_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back: cuts the
    lineage, survives lost executors, and gives later joins a fresh exchange
    that adaptive execution can split when a key is hot."""
    path = scratch_path(df.sparkSession, f"llm-{tag}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_key(docs: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join documents to per-document results. ``side`` grows with the
    documents, so it is never broadcast: the same plan at every size."""
    return docs.join(side.hint("merge"), keys, how)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (int64, from 0) of a string column; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` bytes, or one row if it is longer."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table over the 256 bytes, true outside the given ranges."""
    out = np.ones(256, bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = False
    return out


#: ``[^\x20\x09-\x0D]+`` on UTF-8 bytes (all excluded characters are ASCII).
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on UTF-8 bytes.
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Byte spans of the words of a block and the first word of each row.

    Returns (starts, ends, first) with first of length rows + 1.
    """
    n = len(data)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True                      # a word never crosses a row
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on uint64 (wraps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(r: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i modulo 2**64 for i < n (kept up to a few blocks' length)."""
    have = _POWERS.get(r)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, r, np.uint64), np.full(size, pow(r, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = np.cumprod(up), np.cumprod(down)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[r] = have
    return have[0][:n], have[1][:n]


class Rolling:
    """Polynomial prefix hashes of a sequence: the hash of any slice in O(1).

    A slice's hash depends on its values only, not on where it starts.
    """

    def __init__(self, values: np.ndarray, multiplier: int = MULTIPLIERS[0]):
        n = len(values)
        up, self.down = _powers(multiplier, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 bits as the bigint Spark stores."""
    return np.ascontiguousarray(x).view(np.int64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    if width <= 1:
        return x
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def counted_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... counts[0] values, then the next range."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift
