"""Suffix-array dedup: a collection BWT built column by column.

Operator 3. Treats texts as UTF-8 bytes and removes each byte covered by a
``WIDTH``-byte string that also starts earlier.

Candidates first: a window's anchor is its k-gram with the smallest hash (its
upper 32 bits; the leftmost of equal ones); stretches of windows with one anchor are compared over all
documents by ``anchors.marks``, which settles stretches that are equal as a
whole and drops those whose anchor occurs once. What is left, the stretches
that share an anchor but differ, is a collection of short strings, dealt out
by anchor into buckets of about ``BUCKET_BYTES``.

In each bucket the Burrows-Wheeler transform of the whole collection is built
as in external column-wise construction, over symbols of ``SYMBOL`` bytes (a
string stands for its alignments, so every window is whole symbols of one):
round r inserts the suffix of length
r of every string, that is one symbol per string, and the files of the
transform (suffix order, preceding symbols, common prefixes of neighbours) are
rewritten front to back. A new suffix goes where the old order, by preceding
symbol, has the one that it prolongs; its common prefixes follow from the old
ones by range minima. Buckets are bounded, so these sequential
files are arrays in the task's memory and need no local disk. At the end the
order is cut where the common prefix is under ``WIDTH``: what stays together
is a class of equal strings, and every member after the earliest is a repeat.

An anchor with more than ``HOT`` stretches (a passage in very many documents,
with different text around) would make a large bucket: its windows are dealt
out one by one, by their content, after merging equal ones in each task.

Defined results: null text: empty; texts shorter than the width lose nothing;
a very long text is cut into stretches like any other; a null doc_id is before all others; rows that share a doc_id are one document
as to order, so equal places of theirs remove neither; repeated rows get equal
results; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck.llm import anchors as A
from raincheck.llm import common as C

WIDTH = 100
GRAM = 32
BUCKET_BYTES = 200_000
HOT = 2_000
#: Text bytes of a pass that cuts stretches: its arrays, eight bytes a text byte, stay in a core's cache.
PASS_BYTES = 1 << 15
#: Bytes of a symbol of the transform, or as many as divide the width.
SYMBOL = 4
HIGH = np.uint64(0xFFFFFFFF00000000)
#: The position in a mark; its symbol is above.
LOW = (1 << 32) - 1

PLACES = "d bigint, tag int, start bigint, n int"


def cut_segments(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """(row, start, n, key, h) of the stretches of windows with one anchor."""
    count = np.maximum(np.diff(offsets) - width + 1, 0)
    none = np.zeros(0, np.int64)
    if not count.any():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    rolling = C.Rolling(data)
    n = len(data) - gram + 1
    grams = C.mix((rolling.sums[gram:] - rolling.sums[:-gram]) * rolling.down[:n])
    # The place (Arrow strings are under 2 GB) below half of the hash: the smallest value is
    # the leftmost smallest half, whatever the block's length.
    value = grams & HIGH
    value |= np.arange(n, dtype=np.uint64)
    anchor = C.sliding_min(value, width - gram + 1).astype(np.uint32)
    # Windows of one row only: a stretch begins with a row, and ends with its last window.
    new = np.empty(len(anchor), bool)
    np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
    first, last = offsets[:-1], offsets[:-1] + count
    new[C.counted_ranges(last, np.minimum(offsets[1:], len(new)) - np.minimum(last, len(new)))] = False
    new[first[count > 0]] = True
    start = np.flatnonzero(new)
    row = np.searchsorted(offsets, start, "right") - 1
    size = np.minimum(np.append(start[1:], len(new)), last[row]) - start
    h = C.Rolling(data, C.MULTIPLIERS[1]).of(start, start + size - 1 + width)
    return row, start - offsets[row], size, grams[anchor[start]], h


def wide_columns(data: np.ndarray, offsets: np.ndarray, width: int, size: int):
    """Byte strings as strings of symbols of ``size`` bytes: (symbols, offsets, row, front).

    A string is taken ``size`` times, less its last 0, 1, .. bytes, each in whole
    symbols from its end; ``front`` bytes of ``row`` lie before the first. Every
    ``width``-byte window (``size`` divides ``width``) is then ``width // size``
    symbols of exactly one of them, in a ``size``-th of the columns. Symbols are
    numbered in byte order.
    """
    length = np.repeat(np.diff(offsets), size) - np.tile(np.arange(size), len(offsets) - 1)
    row = np.repeat(np.arange(len(offsets) - 1), size)
    long = length >= width
    length, row = length[long], row[long]
    count, front = length // size, length % size
    ends = np.concatenate(([0], np.cumsum(count)))
    at = np.repeat(offsets[row] + front, count) + size * counted_from_zero(count)
    words = data[at].astype(np.uint64)
    for k in range(1, size):
        words = (words << np.uint64(8)) | data[at + k]
    return np.unique(words, return_inverse=True)[1], ends, row, front


def shared_spans(data: np.ndarray, offsets: np.ndarray, width: int, gram: int = GRAM):
    """(row, first, bytes): of each string the span from its first to its last window that
    may occur again: both halves of such a window, which overlap by ``gram``, do.

    Hashes tell what occurs once, so no repeat is lost; equal hashes decide nothing.
    """
    half = min((width + gram + 1) // 2, width)
    rolling = C.Rolling(data)
    n = len(data) - half + 1
    p = C.counted_ranges(offsets[:-1], np.diff(offsets) - half + 1)
    h = ((rolling.sums[half:] - rolling.sums[:-half]) * rolling.down[:n])[p]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(data), bool)
    again[p[order[1:][same]]] = True
    again[p[order[:-1][same]]] = True
    count = np.diff(offsets) - width + 1
    p = C.counted_ranges(offsets[:-1], count)
    kept = again[p] & again[p + width - half]
    p, row = p[kept], np.repeat(np.arange(len(count)), count)[kept]
    cuts = np.flatnonzero(np.diff(row, prepend=-1, append=len(count)))
    first, last = p[cuts[:-1]], p[cuts[1:] - 1]
    return row[cuts[:-1]], first, last - first + width


def counted_from_zero(counts: np.ndarray) -> np.ndarray:
    return C.counted_ranges(np.zeros(len(counts), np.int64), counts)


class Collection:
    """Suffix order, BWT and common prefixes of a collection of strings, by columns.

    The strings are of bytes or of wider symbols (``wide_columns``). The order
    of the suffixes is (``string``, ``place``); ``bwt`` holds the symbol before
    each (its number + 1, or 0 where a string begins) and ``lcp`` the length of
    the prefix that each shares with the suffix before it.

    During the rounds the transform is kept by symbol: ``marks`` has, for every
    suffix with a symbol before it, symbol and position, in this order. The
    n-th of them is the suffix that follows the n-th non-empty one's first symbol.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        first, last = offsets[:-1], offsets[1:]
        longest = int((last - first).max()) if n else 0
        # Round 0: the empty suffix of every string.
        self.empty, self.marks = n, np.zeros(0, np.int64)
        self.lcp = np.zeros(n, np.uint8 if longest < 255 else np.int32)
        string, place, at = np.arange(n), last.copy(), np.arange(n)
        rounds = []
        for _ in range(longest):
            alive = place > first[string]
            string, place, at = string[alive], place[alive] - 1, at[alive]
            keys = ((data[place].astype(np.int64) + 1) << 32) | at
            order = np.argsort(keys)
            string, place, keys = string[order], place[order], keys[order]
            at = self._insert(keys, self._mark(keys))
            rounds.append(string)
        # Every suffix's position now: the one it prolongs gives it, round by round.
        rank = np.zeros(len(self.lcp), np.int64)
        rank[self.marks & LOW] = np.arange(len(self.marks))
        self.bwt = np.zeros(len(self.lcp), np.uint16 if data.dtype == np.uint8 else np.int32)
        self.bwt[self.marks & LOW] = self.marks >> 32
        self.string, self.place = np.empty(len(self.lcp), np.int64), np.empty(len(self.lcp), np.int64)
        self.string[:n], self.place[:n] = np.arange(n), last
        now, length = np.arange(n), np.zeros(n, np.int64)
        for string in rounds:
            now[string] = n + rank[now[string]]
            length[string] += 1
            self.string[now[string]], self.place[now[string]] = string, last[string] - length[string]

    def _mark(self, keys: np.ndarray) -> np.ndarray:
        """Merge (symbol, position) of the newest suffixes, in order, into the marks; where they went."""
        at = np.searchsorted(self.marks, keys) + np.arange(len(keys))
        rest = np.ones(len(self.marks) + len(keys), bool)
        rest[at] = False
        marks = np.empty(len(rest), np.int64)
        marks[rest], marks[at] = self.marks, keys
        self.marks = marks
        return at

    def _insert(self, keys: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """One symbol per string: put in the suffixes that ``keys``, the marks ``mine``, ask for; their positions.

        Behind the empty suffixes, the order is that of the marks. What a new
        suffix shares with a neighbour of the same first symbol is one more
        than the least common prefix between the two that they prolong.
        """
        at = keys & LOW
        before = self.marks[np.maximum(mine - 1, 0)]
        behind = self.marks[np.minimum(mine + 1, len(self.marks) - 1)]
        has_before = (before >> 32 == keys >> 32) & (before != keys)
        has_behind = (behind >> 32 == keys >> 32) & (behind != keys)
        least = least_of(self.lcp, np.concatenate(((before & LOW)[has_before], at[has_behind])) + 1,
                         np.concatenate((at[has_before], (behind & LOW)[has_behind])) + 1) + 1
        shared = np.zeros((2, len(keys)), self.lcp.dtype)
        cut = np.count_nonzero(has_before)
        shared[0, has_before], shared[1, has_behind] = least[:cut], least[cut:]
        new = self.empty + mine
        size = len(self.lcp) + len(new)
        old = np.ones(size, bool)
        old[new] = False
        lcp = np.empty(size, self.lcp.dtype)
        lcp[old], lcp[new] = self.lcp, shared[0]
        followed = new + 1 < size
        lcp[new[followed] + 1] = shared[1][followed]
        # The old suffixes move back by the new ones before them.
        gaps = np.diff(new - np.arange(len(new)), prepend=0, append=len(self.lcp))
        moved = np.repeat(np.arange(len(new) + 1, dtype=np.int32), gaps)
        self.marks += moved[self.marks & LOW]
        self.lcp = lcp
        return new

    def repeats(self, offsets: np.ndarray, width: int, d: np.ndarray, start: np.ndarray, size: int = 1):
        """(string, place in it, in symbols) of every string of ``width`` symbols that occurs
        earlier. ``start``: the byte in document ``d`` at which each string begins, of symbols of
        ``size`` bytes."""
        same = self.lcp >= width                 # of one class with the suffix before
        member = same.copy()
        member[:-1] |= same[1:]
        string, place, same = self.string[member], self.place[member], same[member]
        at = place - offsets[string]
        if not len(string):
            return string, at
        doc, where = d[string], start[string] + at * size
        cls = np.cumsum(~same) - 1
        order = np.lexsort((where, doc, cls))
        head = np.searchsorted(cls[order], np.arange(cls[-1] + 1))
        first_doc, first_at = doc[order][head][cls], where[order][head][cls]
        later = (doc != first_doc) | (where != first_at)
        return string[later], at[later]


def least_of(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least value of each range [lo, hi), hi > lo, from the least of all ranges of 1, 2, 4.. values."""
    if not len(lo):
        return values[:0]
    power = np.frexp((hi - lo).astype(np.float64))[1] - 1
    n = len(values)
    table = np.empty((int(power.max()) + 1, n), values.dtype)
    table[0] = values
    for k in range(1, len(table)):
        half = 1 << (k - 1)
        np.minimum(table[k - 1, :n - half], table[k - 1, half:], out=table[k, :n - half])
    flat, level = table.reshape(-1), power * np.int64(n)
    return np.minimum(flat[level + lo], flat[level + hi - (np.int64(1) << power)])


def _strings(hot_at: int, buckets: int, width: int):
    """From documents with marks to strings by bucket; n < 0 tells a settled repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, tag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = C.text_bytes(batch.column(2))
            for i, j in C.blocks(offsets, A.PASS_BYTES):
                lists = [batch.column(c).slice(i, j - i) for c in (3, 4, 5, 6)]
                per_row = np.diff(lists[0].offsets.to_numpy())
                start, n, key, hot = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
                row = np.repeat(np.arange(i, j), per_row)
                key = key.astype(np.int64).view(np.uint64)
                n = n.astype(np.int64)
                yield from _emit(data, offsets, row[~hot], start[~hot], n[~hot], key[~hot], d, tag, buckets, width)
                if not hot.any():
                    continue
                # Windows of hot anchors, one by one; equal ones here merge to the earliest.
                part = C.counted_ranges(start[hot], n[hot])
                row, key = np.repeat(row[hot], n[hot]), np.repeat(key[hot], n[hot])
                at = offsets[row] - offsets[i] + part
                block = data[offsets[i]:offsets[j]]
                h1, h2 = (C.Rolling(block, m).of(at, at + width) for m in C.MULTIPLIERS)
                order = np.lexsort((part, d[row], h2, h1))
                h1, h2, part, row, key = h1[order], h2[order], part[order], row[order], key[order]
                new = np.ones(len(part), bool)
                new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                head = np.maximum.accumulate(np.where(new, np.arange(len(part)), 0))
                later = (d[row] != d[row[head]]) | (part != part[head])
                if later.any():
                    docs = d[row[later]]                  # settled: they need not meet others
                    yield _batch(A.anywhere(docs, part[later], buckets), docs, tag[row[later]], part[later],
                                 np.full(len(docs), -1), [None] * len(docs))
                one = np.ones(int((~later).sum()), np.int64)
                yield from _emit(data, offsets, row[~later], part[~later], one, C.mix(key[~later] ^ h1[~later]),
                                 d, tag, buckets, width)

    return run


def _batch(bucket, d, tag, start, n, strings) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket.astype(np.int64)), pa.array(d.astype(np.int64)), pa.array(tag.astype(np.int32)),
         pa.array(start.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(strings, pa.binary())],
        ["bucket", "d", "tag", "start", "n", "s"])


def _emit(data, offsets, row, start, n, key, d, tag, buckets, width):
    bucket = (C.mix(key) % np.uint64(buckets)).astype(np.int64)
    lo = offsets[row] + start
    hi = lo + n - 1 + width
    for i in range(0, len(row), 20_000):
        k = slice(i, i + 20_000)
        yield _batch(bucket[k], d[row[k]], tag[row[k]], start[k], n[k],
                     [data[a:b].tobytes() for a, b in zip(lo[k].tolist(), hi[k].tolist())])


def _compare(width: int):
    def settle(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks()
        n = whole.column("n").to_numpy()
        d, tag, start = (whole.column(c).to_numpy() for c in ("d", "tag", "start"))
        told = n < 0
        out = [(d[told], tag[told], start[told])]
        kept = np.flatnonzero(~told)
        if len(kept) > 1:
            data, offsets = C.text_bytes(whole.column("s").combine_chunks().take(pa.array(kept)))
            d, tag, start = d[kept], tag[kept], start[kept]
            row, first, count = shared_spans(data, offsets, width)
            d, tag, start = d[row], tag[row], start[row] + first - offsets[row]
            data, offsets = data[C.counted_ranges(first, count)], np.concatenate(([0], np.cumsum(count)))
            size = gcd(width, SYMBOL)
            data, offsets, row, front = wide_columns(data, offsets, width, size)
            d, tag, start = d[row], tag[row], start[row] + front
            string, at = Collection(data, offsets).repeats(offsets, width // size, d, start, size)
            out.append((d[string], tag[string], start[string] + at * size))
        d, tag, start = (np.concatenate(x) for x in zip(*out))
        if len(d):
            # Neighbouring places become one range.
            order = np.lexsort((start, tag, d))
            d, tag, start = d[order], tag[order], start[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] != start[:-1] + 1)
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[at]), pa.array(tag[at]), pa.array(start[at]),
                 pa.array(np.diff(np.append(at, len(d))).astype(np.int32))], ["d", "tag", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bucket = [], None
        for batch in batches:
            ids = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if ids[i] != bucket and parts:
                    yield from settle(parts)
                    parts = []
                bucket = ids[i]
                parts.append(batch.slice(i, j - i))
        if parts:
            yield from settle(parts)

    return run


def repeated_places(docs: DataFrame, width: int = WIDTH, hot: int = HOT,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """d, tag, start, n: ranges of byte windows that occur earlier (``docs`` from ``anchors.keyed``)."""
    marks = C.stored(A.marks(docs, cut_segments, width, PASS_BYTES), "marks")
    check = marks.where("not removed")
    crowded = C.stored(check.groupBy("key").count().where(F.col("count") > hot).select(
        "key", F.lit(True).alias("hot")), "crowded")
    check = check.join(crowded, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    total = check.agg(F.sum(F.when(F.col("hot"), F.col("n") * width).otherwise(F.col("n") + width))).first()[0] or 0
    lists = check.groupBy("d", "tag").agg(*[F.collect_list(c).alias(c) for c in ("start", "n", "key", "hot")])
    strings = C.by_key(docs, lists, ["d", "tag"]).select("d", "tag", "text", "start", "n", "key", "hot").mapInArrow(
        _strings(hot, max(1, -(-int(total) // bucket_bytes)), width),
        "bucket bigint, d bigint, tag int, start bigint, n int, s binary")
    found = strings.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_compare(width), PLACES)
    return marks.where("removed").select("d", "tag", "start", "n").unionByName(found)


def _result(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = C.text_bytes(batch.column(1))
            out = []
            for r in range(batch.num_rows):
                part = data[offsets[r]:offsets[r + 1]]
                starts, ns = batch.column(2)[r], batch.column(3)[r]
                removed = spans = 0
                kept = part
                if starts.is_valid:
                    gone = A.covered(starts.values.to_numpy().astype(np.int64), ns.values.to_numpy().astype(np.int64),
                                     width, len(part))
                    removed = int(gone.sum())
                    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                    kept = part[~gone]
                out.append((len(part), removed, spans, kept.tobytes()))
            n, removed, spans, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array([sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup_bytes(docs: DataFrame, width: int = WIDTH, hot: int = HOT, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay)."""
    docs = A.keyed(docs)
    places = repeated_places(docs, width, hot, bucket_bytes)
    gone = C.stored(places.groupBy("d", "tag").agg(
        F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns")), "gone")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return C.by_key(docs, gone, ["d", "tag"], "left").select("doc_id", "text", "starts", "ns").mapInArrow(
        _result(width), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def query(spark, sf_dir: str) -> DataFrame:
    return dedup_bytes(C.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


ORACLE = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), chunks AS (
  SELECT doc_id, c, substr(x, 2 * c + 1, 1198) AS x
  FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99, 500)) AS c FROM bytes WHERE len(x) >= 200)
), windows AS (
  SELECT doc_id, c + i AS p, md5(substr(x, 2 * i + 1, 200)) AS s
  FROM (SELECT doc_id, c, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM chunks)
), later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
), marked AS (
  SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, true) AS opens FROM later
), numbered AS (
  SELECT doc_id, p, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked
), spans AS (
  SELECT doc_id, run, min(p) AS lo, max(p) + 100 AS hi FROM numbered GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS kept_from FROM spans
), kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * kept_from + 1, 2 * (lo - kept_from)), '' ORDER BY lo) AS head,
    max(hi) AS tail_from, sum(hi - lo) AS n_removed, count(*) AS n_spans
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT bytes.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(tail_from, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)
"""
