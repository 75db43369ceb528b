"""Substring dedup by recompression.

Operator 2. Removes every word that is covered by a window of ``WINDOW``
consecutive words whose sequence also starts earlier.

Each document's words are renamed in rounds, all documents at once over the
partitions of the table: first maximal runs of one word get a name, then, in
each pair round, every symbol falls into a left or a right class and each left
symbol followed by a right one becomes a pair with a name. A name is a 64-bit
hash of the names it replaces, so the naming is the same in every task with no
exchange between rounds. What a symbol becomes depends on a few neighbours
only; the range of words that determine it is tracked along, so equal
substrings have the same symbols wherever that range lies inside them. The
smallest-hash symbol of the highest such level is a window's anchor. Anchors
shared by two places reveal the candidates (``anchors.marks``); segments equal
as a whole are settled there, and the windows of all others are compared one
by one with a grouped minimum over 128-bit content hashes.

Defined results: null text: no words; a text of fewer words than a window
loses nothing; a null doc_id is before all others; rows that share a doc_id
are one document as to order, so equal places of theirs remove neither;
repeated rows get equal results; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck.llm import anchors as A
from raincheck.llm import common as C

WINDOW = 20
#: Pair rounds; with two, a symbol is determined by 4 to 9 words.
ROUNDS = 2


class Level:
    """Symbols of a block in order: name and the words [dlo, dhi) that determine them."""

    def __init__(self, name, dlo, dhi, row):
        self.name, self.dlo, self.dhi, self.row = name, dlo, dhi, row


def runs(words: np.ndarray, first: np.ndarray) -> Level:
    """Name maximal runs. A run is determined by itself and the word on either side;
    at a document's edge that lies outside of every window."""
    n = len(words)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begins = np.ones(n, bool)
    begins[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
    lo = np.flatnonzero(begins)
    hi = np.append(lo[1:], n)
    size = hi - lo
    name = words[lo]
    name = np.where(size > 1, C.mix(name + size.astype(np.uint64) * np.uint64(C.MULTIPLIERS[0])), name)
    return Level(name, lo - 1, hi + 1, row[lo])


def pairs(level: Level, first: np.ndarray, turn: int) -> Level:
    """Name each left-class symbol that is followed by a right-class one."""
    name, dlo, dhi, row = level.name, level.dlo, level.dhi, level.row
    n = len(name)
    right = (C.mix(name + np.uint64(turn + 1)) & np.uint64(1)).astype(bool)
    same = np.zeros(n, bool)                               # followed by a symbol of its row
    same[:-1] = row[1:] == row[:-1]
    joins = np.zeros(n, bool)
    joins[:-1] = same[:-1] & ~right[:-1] & right[1:]
    taken = np.zeros(n, bool)
    taken[1:] = joins[:-1]
    # A left symbol has looked at the next one, a right symbol at the one before.
    next_dhi = np.append(dhi[1:], 0)
    prev_dlo = np.append(0, dlo[:-1])
    before = np.append(False, same[:-1])
    new_dhi = np.where(right, dhi, np.where(same, next_dhi, first[row + 1] + 1))
    new_dlo = np.where(right, np.where(before, prev_dlo, first[row] - 1), dlo)
    pair = np.empty(n, np.uint64)
    pair[:-1] = C.mix(name[:-1] * np.uint64(C.MULTIPLIERS[0]) + C.mix(name[1:]) + np.uint64(turn))
    keep = ~taken
    return Level(np.where(joins, pair, name)[keep] if n else name, new_dlo[keep], new_dhi[keep], row[keep])


def _least(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of the leftmost smallest value of each range [a, b), b > a."""
    table = [np.arange(len(h))]
    width = int((b - a).max())
    while 2 ** len(table) <= width:
        half = 2 ** (len(table) - 1)
        x, y = table[-1][:-half], table[-1][half:]
        table.append(np.where(h[x] <= h[y], x, y))
    out = np.empty(len(a), np.int64)
    size = np.frexp((b - a).astype(float))[1] - 1
    for k, t in enumerate(table):
        of = np.flatnonzero(size == k)
        x, y = t[a[of]], t[b[of] - (1 << k)]
        out[of] = np.where(h[x] <= h[y], x, y)
    return out


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    count = np.maximum(np.diff(first) - width + 1, 0)
    return C.counted_ranges(first[:-1], count)


def cut_segments(data: np.ndarray, offsets: np.ndarray, width: int = WINDOW, rounds: int = ROUNDS):
    """(row, start, n, key, h) of the segments of a block; starts count words in the row."""
    starts, ends, first = C.word_spans(data, offsets, C.NOT_SPACE)
    p = window_starts(first, width)
    none = np.zeros(0, np.int64)
    if not len(p):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    words = C.Rolling(data).of(starts, ends)
    levels = [runs(words, first)]
    for turn in range(rounds):
        levels.append(pairs(levels[-1], first, turn))
    # The anchor of each window: highest level with a symbol that the window determines.
    anchor = np.full(len(p), -1, np.int64)
    lo, hi = p.copy(), p + width                           # without any: the window is its own anchor
    todo, base = np.arange(len(p)), 0
    for level in reversed(levels):
        a = np.searchsorted(level.dlo, p[todo], "left")
        b = np.searchsorted(level.dhi, p[todo] + width, "right")
        has = b > a
        if has.any():
            at = todo[has]
            best = _least(C.mix(level.name), a[has], b[has])
            anchor[at] = base + best
            lo[at], hi[at] = level.dlo[best], level.dhi[best]
        base += len(level.name)
        todo = todo[~has]
        if not len(todo):
            break
    row = np.searchsorted(first, p, "right") - 1
    new = np.ones(len(p), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (p[1:] != p[:-1] + 1) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(p)))
    content = C.Rolling(words)
    key = C.mix(content.of(lo[at], hi[at]))
    h = C.Rolling(words, C.MULTIPLIERS[1]).of(p[at], p[at] + n - 1 + width)
    return row[at], p[at] - first[row[at]], n, key, h


def _lists(marks: DataFrame) -> DataFrame:
    return marks.groupBy("d", "tag").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """d, tag, start and 128-bit hash of the windows to be compared."""
    for batch in batches:
        d, tag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        data, offsets = C.text_bytes(batch.column(2))
        starts, ns = batch.column(3), batch.column(4)
        for i, j in C.blocks(offsets):
            part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            begin, end, first = C.word_spans(part, off, C.NOT_SPACE)
            bytes_ = C.Rolling(part), C.Rolling(part, C.MULTIPLIERS[1])
            words = [C.Rolling(b.of(begin, end), m) for b, m in zip(bytes_, C.MULTIPLIERS)]
            at, row = [], []
            for r in range(i, j):
                s = np.asarray(starts[r].values.to_numpy(), np.int64)
                n = np.asarray(ns[r].values.to_numpy(), np.int64)
                p = C.counted_ranges(s, n)
                at.append(p + first[r - i])
                row.append(np.full(len(p), r))
            at, row = np.concatenate(at), np.concatenate(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[row]), pa.array(tag[row]), pa.array(at - first[row - i]),
                 *(pa.array(C.signed(w.of(at, at + WINDOW))) for w in words)], ["d", "tag", "start", "a", "b"])


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        data, offsets = C.text_bytes(batch.column(1))
        for r in range(batch.num_rows):
            part = data[offsets[r]:offsets[r + 1]]
            begin, end, _ = C.word_spans(part, np.array([0, len(part)]), C.NOT_SPACE)
            raw = part.tobytes()
            starts, ns = batch.column(2)[r], batch.column(3)[r]
            gone = np.zeros(len(begin), bool)
            if starts.is_valid:
                gone = A.covered(starts.values.to_numpy().astype(np.int64), ns.values.to_numpy().astype(np.int64),
                                 WINDOW, len(begin))
            kept = b" ".join([raw[a:b] for a, b in zip(begin[~gone].tolist(), end[~gone].tolist())])
            out.append((len(begin), int(gone.sum()), kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
             pa.array([sha256(o[2]).hexdigest() for o in out], pa.string()),
             pa.array([o[2].decode("utf-8", "replace") for o in out], pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def repeated_places(docs: DataFrame) -> DataFrame:
    """d, tag, start, n: ranges of windows that occur earlier (``docs`` from ``anchors.keyed``)."""
    marks = C.stored(A.marks(docs, cut_segments, WINDOW), "marks")
    check = _lists(marks.where("not removed"))
    windows = C.by_key(docs, check, ["d", "tag"]).select("d", "tag", "text", "starts", "ns").mapInArrow(
        _windows, "d bigint, tag int, start bigint, a bigint, b bigint")
    windows = C.stored(windows, "windows")
    firsts = windows.groupBy("a", "b").agg(
        F.min(F.struct("d", "start")).alias("first"), F.max(F.struct("d", "start")).alias("last"))
    firsts = C.stored(firsts.where(F.col("first") < F.col("last")).select("a", "b", "first"), "first-windows")
    later = windows.join(firsts, ["a", "b"]).where(F.struct("d", "start") > F.col("first"))
    return marks.where("removed").select("d", "tag", "start", "n").unionByName(
        later.select("d", "tag", "start", F.lit(1).alias("n")))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: the words that stay, joined by one space."""
    docs = A.keyed(docs)
    gone = C.stored(_lists(repeated_places(docs)), "gone")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return C.by_key(docs, gone, ["d", "tag"], "left").select("doc_id", "text", "starts", "ns").mapInArrow(
        _result, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def query(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(C.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


ORACLE = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM w WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
), covered AS (
  SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(p, p + 20)) AS k FROM later) GROUP BY doc_id
), words AS (
  SELECT doc_id, k, w[k] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM w)
), gone AS (SELECT doc_id, unnest(ks) AS k FROM covered
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.k) AS s
  FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.k = gone.k GROUP BY words.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(s, '')) AS kept_sha256
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
