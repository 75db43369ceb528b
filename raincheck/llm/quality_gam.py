"""Quality classifier: a generalised additive model with pairwise interactions.

Operator 6. A text is described by counts and shares (lengths, letter classes,
repetition); each feature is cut into bins at quantiles of the training rows.
The model is an intercept plus one lookup table per feature and one per chosen
pair of features, on the log-odds scale. Training boosts in cycles: for one
feature after another a shallow regression tree over its bins is fitted to the
current residuals and its leaf values, shrunk, are added to the feature's
table; pairs are ranked by how much of the residual a coarse grid of them
explains, and the best are boosted the same way over two-dimensional bins.
Scoring adds up table entries, vectorised over the rows of a batch.

Training rows are bounded by ``max_rows`` (labels of smallest id hash, and of
documents that share an id one: smallest text hash, then features), so the
matrix the driver trains on is at most that many rows of the fixed features;
scoring covers every row of the table in one map with no shuffle.

Defined results: null text: empty; empty texts get a score like any other;
labels with null quality or id, or of unknown documents, are not learned; with
no labels, or one class only, the score is the (smoothed) share of good labels,
0.5 with none; repeated rows get equal scores; an empty table gives no rows;
other columns are not read by the score and are carried along by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raincheck.llm import common as C

FEATURES = (
    "log_bytes", "log_words", "mean_word", "long_words", "upper", "digit", "space", "symbol", "stop_mark",
    "non_ascii", "symbol_words", "upper_words", "same_as_before", "distinct_words", "top_word",
    "words_per_line", "lone_symbols",
)
MAX_ROWS = 20_000
BINS = 24
CYCLES = 60
RATE = 0.15
PAIRS = 6
THRESHOLD = 0.3


def _lookup(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER, _DIGIT = _lookup("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _lookup("0123456789")
_SPACE, _STOP = ~C.NOT_SPACE, _lookup(".,")
_SYMBOL = _lookup("!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Feature matrix (rows x FEATURES) of a block of texts."""
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(float)

    def per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (sums[edges[1:]] - sums[edges[:-1]]).astype(float)

    starts, ends, first = C.word_spans(data, offsets, C.NOT_SPACE)
    words = np.diff(first).astype(float)
    length = ends - starts
    some, any_word = np.maximum(size, 1), np.maximum(words, 1)
    byte_sums = {k: np.concatenate(([0], np.cumsum(f[data], dtype=np.int64)))
                 for k, f in (("u", _UPPER), ("s", _SYMBOL))}
    in_word = {k: s[ends] - s[starts] for k, s in byte_sums.items()}
    h = C.Rolling(data).of(starts, ends)
    before = np.zeros(len(h), bool)
    before[1:] = h[1:] == h[:-1]
    before[first[:-1][words > 0]] = False
    row_of = np.repeat(np.arange(rows), np.diff(first))
    order = np.lexsort((h, row_of))
    sh, sr = h[order], row_of[order]
    new = np.ones(len(h), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (sr[1:] != sr[:-1])
    runs = np.flatnonzero(new)
    top = np.zeros(rows)
    np.maximum.at(top, sr[runs], np.diff(np.append(runs, len(h))))
    distinct = np.bincount(sr[runs], minlength=rows).astype(float)
    lines = per_row(data == 10, offsets) + 1
    out = np.column_stack([
        np.log1p(size), np.log1p(words), per_row(length, first) / any_word,
        per_row(length > 12, first) / any_word, per_row(_UPPER[data], offsets) / some,
        per_row(_DIGIT[data], offsets) / some, per_row(_SPACE[data], offsets) / some,
        per_row(_SYMBOL[data], offsets) / some, per_row(_STOP[data], offsets) / some,
        per_row(data >= 128, offsets) / some, per_row(in_word["s"] >= 2, first) / any_word,
        per_row((in_word["u"] * 2 > length) & (length > 1), first) / any_word,
        per_row(before, first) / any_word, distinct / any_word, top / any_word,
        np.log1p(words / lines), per_row((length == 1) & (in_word["s"] == 1), first) / any_word,
    ])
    return np.where(size[:, None] > 0, out, 0.0)


def _tree(g: np.ndarray, n: np.ndarray, lo: int, hi: int, depth: int, least: float, out: np.ndarray) -> None:
    """Leaf means of a shallow tree over ordered bins [lo, hi), into ``out``."""
    total, count = g[lo:hi].sum(), n[lo:hi].sum()
    if depth and hi - lo > 1:
        cg, cn = np.cumsum(g[lo:hi])[:-1], np.cumsum(n[lo:hi])[:-1]
        fit = (cn >= least) & (count - cn >= least)
        if fit.any():
            gain = np.where(fit, cg ** 2 / np.maximum(cn, 1e-9) + (total - cg) ** 2 / np.maximum(count - cn, 1e-9), -1)
            k = lo + int(np.argmax(gain)) + 1
            _tree(g, n, lo, k, depth - 1, least, out)
            _tree(g, n, k, hi, depth - 1, least, out)
            return
    out[lo:hi] = total / max(count, 1e-9)


def _tree2(g: np.ndarray, n: np.ndarray, depth: int, least: float, out: np.ndarray) -> None:
    """The same over a grid: the best cut of either axis, then within the parts."""
    total, count = g.sum(), n.sum()
    best = (-1.0, 0, 0)
    if depth:
        for axis in (0, 1):
            cg, cn = np.cumsum(g.sum(1 - axis))[:-1], np.cumsum(n.sum(1 - axis))[:-1]
            fit = (cn >= least) & (count - cn >= least)
            if fit.any():
                gain = np.where(fit, cg ** 2 / np.maximum(cn, 1e-9) + (total - cg) ** 2 / np.maximum(count - cn, 1e-9), -1)
                k = int(np.argmax(gain))
                best = max(best, (float(gain[k]), axis, k + 1))
    if best[0] < 0:
        out[...] = total / max(count, 1e-9)
        return
    _, axis, k = best
    for part in (slice(0, k), slice(k, None)):
        at = (part, slice(None)) if axis == 0 else (slice(None), part)
        _tree2(g[at], n[at], depth - 1, least, out[at])


class Model:
    """Bin edges, lookup tables per feature and per pair, intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bins: int = BINS, cycles: int = CYCLES,
                 rate: float = RATE, pairs: int = PAIRS):
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)
                      for j in range(len(FEATURES))]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        p = (y.sum() + 1) / (len(y) + 2)
        self.intercept = float(np.log(p / (1 - p)))
        if len(y) == 0 or y.min() == y.max():
            return
        b = self.binned(x)
        f = np.full(len(y), self.intercept)
        least = max(2.0, len(y) / 400)
        counts = [np.bincount(b[j], minlength=len(t)).astype(float) for j, t in enumerate(self.tables)]
        for _ in range(cycles):
            for j, table in enumerate(self.tables):
                r = y - 1 / (1 + np.exp(-f))
                step = np.zeros(len(table))
                _tree(np.bincount(b[j], r, len(table)), counts[j], 0, len(table), 2, least, step)
                step *= rate * 4                      # a logistic residual is at most 1/4 of its log odds
                table += step
                f += step[b[j]]
        r = y - 1 / (1 + np.exp(-f))
        gains = []
        for j in range(len(FEATURES)):
            for k in range(j):
                cell = (b[j] * 6 // len(self.tables[j])) * 6 + b[k] * 6 // len(self.tables[k])
                g, n = np.bincount(cell, r, 36), np.bincount(cell, minlength=36)
                gains.append((float((g ** 2 / np.maximum(n, 1)).sum()), j, k))
        for _, j, k in sorted(gains, reverse=True)[:pairs]:
            self.pairs.append((j, k))
            self.pair_tables.append(np.zeros((len(self.tables[j]), len(self.tables[k]))))
        for _ in range(cycles // 3):
            for (j, k), table in zip(self.pairs, self.pair_tables):
                r = y - 1 / (1 + np.exp(-f))
                cell = b[j] * table.shape[1] + b[k]
                step = np.zeros(table.shape)
                _tree2(np.bincount(cell, r, table.size).reshape(table.shape),
                       np.bincount(cell, minlength=table.size).reshape(table.shape).astype(float), 3, least, step)
                step *= rate * 4
                table += step
                f += step.ravel()[cell]

    def binned(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        f = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            f += table[b[j]]
        for (j, k), table in zip(self.pairs, self.pair_tables):
            f += table[b[j], b[k]]
        return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on labelled rows that are not held out, at most ``max_rows``."""
    chosen = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    chosen = C.stored(chosen.select(F.col("doc_id").alias("__id"), "quality"), "labelled")
    # Bounded by max_rows rows of 12 bytes, so it may be broadcast. The documents
    # of a labelled id are not bounded: one of each id is kept before the collect.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("y", T.IntegerType()),
                           T.StructField("th", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    found = rows.select(F.col("doc_id").cast("bigint"), "quality", C.row_key(), "text").mapInArrow(_labelled, schema)
    got = (found.groupBy("id").agg(F.min(F.struct("th", "x", "y")).alias("one"))
           .select("id", "one.y", "one.x").toArrow())
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = got.column("y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y, got.column("id").to_numpy()))       # not the order of arrival
    return Model(x[order], y[order])


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = C.text_bytes(batch.column(3))
        for i, j in C.blocks(offsets):
            x = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(i, j - i) for c in range(3)), pa.array(list(x), pa.list_(pa.float64()))],
                ["id", "y", "th", "x"])


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of every whole text added as ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    where, names = docs.columns.index("text"), [*docs.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            data, offsets = C.text_bytes(batch.column(where))
            for i, j in C.blocks(offsets):
                s = fitted.scores(features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(s)], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def query(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, C.table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = train(docs.select("doc_id", "text"), C.table(spark, sf_dir, "labels"))
    return score(docs, model, "__score").where(F.col("__score") >= THRESHOLD).drop("__score")
