"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Operator 9. The patterns are the test items' windows of ``n`` consecutive
words (an item with fewer words is one pattern). Patterns of one length m form
one search machine: a SHIFT table over blocks of two words says how far the
end of the search window may jump, a block that ends a pattern has shift 0 and
leads to a bucket of patterns that share that suffix hash, and the words
themselves are compared to confirm. Many stretches of text advance in step as
numpy arrays, each by its own shift.

Spark splits the items into distinct patterns and deals these by hash into
blocks of about ``max_patterns`` rows and ``max_bytes`` bytes. The tables of a
block are the only broadcast, and one block is live at a time: the first is
searched for in the map that returns the documents, each further one in a pass
of its own that writes the texts it hits, after which its broadcast is
destroyed. Written hits meet their documents by the hash of the text, a merge
join that is needed for more than one block only. No size is refused.

Defined results: null and empty texts have no words and are never hit; null or
empty items give no pattern; a null item_id counts as the empty string;
repeated items and repeated documents give the same answer as one, and
documents with the same text the same hits; of items that share a pattern all
are named; a very long text is searched in stretches, a very long word is one
word (and the one pattern row that may exceed a block's bytes); an empty
benchmark hits nothing; an empty documents table gives no rows. Input columns
are passed through under any name, results are added under the names given.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raincheck.llm import common as C

WINDOW_WORDS = 10
BLOCK = 2
#: Pattern rows and bytes that one broadcast block aims at, and a row's bytes beside its text.
MAX_PATTERNS = 200_000
MAX_BYTES = 16 << 20
ROW_BYTES = 64
#: Patterns of one batch that the splitting of items passes on.
_BATCH = 4_096
#: Window ends that one search cursor covers.
STRETCH = 256

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def split_words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, word spans, first word of each row, word hashes."""
    low = C.LOWER[data]
    starts, ends, first = C.word_spans(low, offsets, C.ALNUM)
    return low, starts, ends, first, C.Rolling(low).of(starts, ends)


def text_words(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    low, starts, ends, _, _ = split_words(raw, np.array([0, len(raw)]))
    low = low.tobytes()
    return [low[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def _block_hash(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that end at each position."""
    h = words[at]
    for back in range(1, size):
        h = h * np.uint64(C.MULTIPLIERS[1]) + words[at - back]
    return C.mix(h)


class Machine:
    """Wu-Manber tables for patterns of ``m`` words each."""

    def __init__(self, m: int, patterns: list[list[bytes]], numbers: list[int]):
        self.m, self.block = m, min(BLOCK, m)
        joined = b"".join(w for p in patterns for w in p)
        lengths = np.array([len(w) for p in patterns for w in p], np.int64)
        ends = np.cumsum(lengths)
        words = C.Rolling(np.frombuffer(joined, np.uint8)).of(ends - lengths, ends)
        grid = words.reshape(len(patterns), m)
        bits = max(12, int(len(patterns) * m).bit_length() + 3)
        self.mask = np.uint64((1 << bits) - 1)
        top = m - self.block + 1                       # the longest jump
        self.shift = np.full(1 << bits, min(top, 255), np.uint8)
        base = np.arange(len(patterns), dtype=np.int64) * m
        for q in range(self.block - 1, m):             # a block that ends at word q
            slot = (_block_hash(words, base + q, self.block) & self.mask).astype(np.int64)
            np.minimum.at(self.shift, slot, min(m - 1 - q, 255))
        # Buckets of patterns by their last block; the first word filters further.
        self.suffix = _block_hash(words, base + m - 1, self.block)
        order = np.argsort(self.suffix, kind="stable")
        self.suffix, self.prefix = self.suffix[order], grid[order, 0]
        self.numbers = np.array(numbers, np.int64)[order]
        self.texts = [b" ".join(patterns[i]) for i in order]

    def search(self, low: bytes, starts, ends, first, words) -> tuple[list[int], list[int]]:
        """(word index where a match starts, pattern number) over all rows of a block."""
        counts = np.diff(first) - (self.m - 1)         # window ends of each row
        rows = np.flatnonzero(counts > 0)
        pieces = -(-counts[rows] // STRETCH)
        base = np.repeat(first[rows] + self.m - 1, pieces) + STRETCH * C.counted_ranges(
            np.zeros(len(rows), np.int64), pieces)
        limit = np.minimum(base + STRETCH, np.repeat(first[rows + 1], pieces))
        at, found = base, []
        while len(at):
            jump = self.shift[(_block_hash(words, at, self.block) & self.mask).astype(np.int64)].astype(np.int64)
            if not jump.all():
                found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            going = at < limit
            at, limit = at[going], limit[going]
        if not found:
            return [], []
        at = np.concatenate(found)
        h = _block_hash(words, at, self.block)
        lo, hi = np.searchsorted(self.suffix, h, "left"), np.searchsorted(self.suffix, h, "right")
        which = C.counted_ranges(lo, hi - lo)
        at = np.repeat(at, hi - lo) - (self.m - 1)
        same = self.prefix[which] == words[at]
        hits, numbers = [], []
        for a, k in zip(at[same].tolist(), which[same].tolist()):
            text = b" ".join([low[starts[i]:ends[i]] for i in range(a, a + self.m)])
            if text == self.texts[k]:
                hits.append(a)
                numbers.append(int(self.numbers[k]))
        return hits, numbers


class Patterns:
    """The machines of one block of items, and which items a pattern is of."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.items = [sorted(ids) for ids in windows.values()]
        by_length: dict[int, tuple[list, list]] = {}
        for k, words in enumerate(windows):
            have = by_length.setdefault(len(words), ([], []))
            have[0].append(list(words))
            have[1].append(k)
        self.machines = [Machine(m, p, k) for m, (p, k) in sorted(by_length.items())]

    def match(self, data: np.ndarray, offsets: np.ndarray):
        """Per row: number of words, sorted hit word indices, item ids."""
        low, starts, ends, first, words = split_words(data, offsets)
        rows = len(offsets) - 1
        hit = np.zeros(len(starts) + 1, np.int64)
        ids: list[set[str]] = [set() for _ in range(rows)]
        raw = low.tobytes()
        for machine in self.machines:
            at, numbers = machine.search(raw, starts, ends, first, words)
            if at:
                at = np.array(at)
                np.add.at(hit, at, 1)
                np.add.at(hit, at + machine.m, -1)
                for row, k in set(zip((np.searchsorted(first, at, "right") - 1).tolist(), numbers)):
                    ids[row].update(self.items[k])
        covered = np.flatnonzero(np.cumsum(hit[:-1]) > 0)
        edges = np.searchsorted(covered, first)
        return np.diff(first), [covered[edges[r]:edges[r + 1]] - first[r] for r in range(rows)], ids


def pattern_rows(items: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """pattern (its words, one space between), item: the distinct patterns of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text_words(text)
                count = max(1, len(words) - n + 1) if words else 0
                for at in range(0, count, _BATCH):
                    part = [b" ".join(words[i:i + n]) for i in range(at, min(at + _BATCH, count))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.binary()), pa.array([item] * len(part), pa.string())], ["pattern", "item"])

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return rows.mapInArrow(run, "pattern binary, item string").distinct()


def read_block(rows: DataFrame, k: int, blocks: int) -> Patterns:
    """The tables of one block of patterns; the driver holds no other meanwhile."""
    windows: dict[tuple[bytes, ...], set[str]] = {}
    block = rows.where(F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks)) == k).toArrow()
    for pattern, item in zip(block.column(0).to_pylist(), block.column(1).to_pylist()):
        windows.setdefault(tuple(pattern.split(b" ")), set()).add(item)
    return Patterns(windows)


def match_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", out: str = "hits",
                    n: int = WINDOW_WORDS, max_patterns: int = MAX_PATTERNS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Add ``out``: struct(n_words, hit_words: indices of hit words, items: ids)."""
    share = docs.sparkSession.sparkContext.broadcast
    rows = C.stored(pattern_rows(items, n), "patterns")
    size = F.octet_length("pattern") + F.octet_length("item") + F.lit(ROW_BYTES)
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    blocks = max(1, -(-count // max_patterns), -(-total // max_bytes))

    key = "__key"
    while key in docs.columns:
        key += "_"
    of_text = F.md5(F.coalesce(F.col(text), F.lit("")))
    written = []
    for k in range(1, blocks):
        tables = share(read_block(rows, k, blocks))
        hits = _searched(docs.select(of_text.alias(key), text), tables, 1, "h").where(F.size("h.hit_words") > 0)
        written.append(C.stored(hits.groupBy(key).agg(F.first("h").alias("h")), "block-hits"))
        tables.destroy()

    found = _searched(docs, share(read_block(rows, 0, blocks)), docs.columns.index(text), out)
    if not written:
        return found
    more = reduce(DataFrame.unionByName, written).groupBy(key).agg(          # a row of each block at most
        F.flatten(F.collect_list("h.hit_words")).alias("w"), F.flatten(F.collect_list("h.items")).alias("i"))
    more = C.stored(more.select(key, F.struct("w", "i").alias(key + "more")), "hits")
    found = C.by_key(found.withColumn(key, of_text), more, [key], "left")
    first, rest = F.col(out), F.col(key + "more")
    merged = F.struct(first["n_words"].alias("n_words"), *[
        F.when(rest.isNull(), first[a]).otherwise(F.array_sort(F.array_union(first[a], rest[b]))).alias(a)
        for a, b in (("hit_words", "w"), ("items", "i"))])
    return found.select(*docs.columns, merged.alias(out))


def _searched(docs: DataFrame, shared, where: int, out: str) -> DataFrame:
    """Add ``out`` for the patterns of one block; the text is column number ``where``."""
    kind = pa.struct([("n_words", pa.int64()), ("hit_words", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value
        for batch in batches:
            data, offsets = C.text_bytes(batch.column(where))
            for i, j in C.blocks(offsets):
                part = batch.slice(i, j - i)
                counts, covered, ids = patterns.match(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                found = pa.StructArray.from_arrays(
                    [pa.array(counts, pa.int64()), pa.array([c.astype(np.int32) for c in covered], pa.list_(pa.int32())),
                     pa.array([sorted(s) for s in ids], pa.list_(pa.string()))], fields=list(kind))
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, RESULT)]))


def query(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = match_benchmark(docs, C.table(spark, sf_dir, "benchmark"))
    h = F.col("hits")
    return found.select(
        "doc_id", h["n_words"].alias("n_words"), F.size(h["hit_words"]).cast("bigint").alias("n_hit"),
        F.size(h["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(h["items"]), ","), 256).alias("items_sha256"),
        (F.size(h["hit_words"]) > 0).alias("contaminated"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any hit word."""
    found = match_benchmark(docs, C.table(spark, sf_dir, "benchmark"), out="__hits")
    return found.where(F.size(F.col("__hits")["hit_words"]) == 0).select(*[found[c] for c in docs.columns])


ORACLE = """
WITH words AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', CAST(item_id AS VARCHAR), regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
), patterns AS (
  SELECT DISTINCT id AS item, least(len(w), 10) AS m, array_to_string(w[p:p + 9], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM words
        WHERE kind = 'i' AND len(w) > 0)
), sizes AS (SELECT DISTINCT m FROM patterns
), windows AS (
  SELECT id, m, p, array_to_string(w[p:p + m - 1], ' ') AS s
  FROM (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM words, sizes
        WHERE kind = 'd' AND len(w) >= m)
), found AS (
  SELECT id, windows.m, p, item FROM windows JOIN patterns ON windows.m = patterns.m AND windows.s = patterns.s
), hit AS (
  SELECT id, count(DISTINCT k) AS n_hit FROM (SELECT id, unnest(range(p, p + m)) AS k FROM found) GROUP BY id
), named AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT id, item FROM found) GROUP BY id
)
SELECT CAST(words.id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (id) LEFT JOIN named USING (id) WHERE kind = 'd'
"""
