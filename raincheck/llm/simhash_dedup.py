"""SimHash near-dedup with a Gray-order hierarchical index.

Operator 7. A document's 64-bit fingerprint takes the majority of each bit
over the XXH64 hashes of its word shingles. Documents whose fingerprints
differ in at most ``max_distance`` bits are linked, and linked documents form
components.

Links are found between distinct fingerprints. The 64 bits are cut into blocks
of which any two linked fingerprints must agree on some (``masks``), and each
fingerprint goes to one group per mask, keyed by its bits under that mask.
Inside a group, of whatever size, the fingerprints are sorted by Gray rank, so
that neighbours share most bits; upper nodes over consecutive fingerprints keep
the bits that all their members share. Two nodes whose shared bits already
differ too much are dropped with everything below them; a child adds only the
bits that its parents had not compared yet to the differences accumulated so
far, until single fingerprints have been compared in all bits. A group gives
one row per linked fingerprint (to its local root), never the pairs; groups of
more than ``most`` fingerprints are dealt out as pairs of chunks, so that no
task holds more than two chunks. Components are then joined over all groups by
smallest-label steps with pointer jumping on written tables.

Defined results: null text: no words; no words: fingerprint 0, linked like any
other; a null doc_id comes before all others and is its own component_id only
as null; rows that share a doc_id are each fingerprinted from their own text
and may be in different components; an empty table gives no rows; extra
columns are not read. ``stage`` keeps, of each component, one row with the
smallest id, with all columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raincheck.llm import common as C

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
#: Fingerprints of one group that one task compares at a time (two chunks of it).
MOST = 8_192
#: Group size that the masks aim at.
GROUP = 1_024
#: Children of a node, and pairs of nodes that are compared at a time.
FAN = 2
PAIRS = 16_384


# -- fingerprints ---------------------------------------------------------

def simhash(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64) of a block of texts."""
    rows = len(offsets) - 1
    low = C.LOWER[data]
    starts, ends, first = C.word_spans(low, offsets, C.NOT_SPACE)
    out = np.zeros(rows, np.uint64)
    if not len(starts):
        return out
    # The words, one space after each: every shingle is one slice of this.
    size = ends - starts + 1
    new_ends = np.cumsum(size) - 1
    new_starts = new_ends - (size - 1)
    flat = np.full(int(new_ends[-1]) + 1, 0x20, np.uint8)
    flat[C.counted_ranges(new_starts, size - 1)] = low[C.counted_ranges(starts, size - 1)]
    words = np.diff(first)
    count = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    head = np.repeat(first[:-1], count) + C.counted_ranges(np.zeros(rows, np.int64), count)
    last = np.minimum(head + shingle, np.repeat(first[1:], count)) - 1
    raw, digest = flat.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(new_starts[head].tolist(), new_ends[last].tolist())),
                    np.uint64, len(head))
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    some = np.flatnonzero(count)
    at = np.concatenate(([0], np.cumsum(count[some])[:-1]))
    set_bits = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    major = (2 * set_bits > count[some, None]).astype(np.uint8)
    out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, d (its order key), th (hash of the text), fp: one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = C.text_bytes(batch.column(3))
            for i, j in C.blocks(offsets):
                fp = simhash(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], shingle)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, j - i).columns[:3], pa.array(C.signed(fp))], ["doc_id", "d", "th", "fp"])

    rows = docs.select("doc_id", C.doc_key().alias("d"), C.row_key().alias("th"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, d bigint, th bigint, fp bigint")


# -- the index of one group -----------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    x = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class Components:
    """Smallest member of each component of 0 .. n-1, grown by links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


class Index:
    """Hierarchy over fingerprints in Gray order; nodes keep their shared bits.

    The lowest nodes are the fingerprints themselves, which share all bits with
    themselves, so the differences accumulated down to them are exact.
    ``looked`` and ``dropped`` count the pairs of upper nodes, and those of them
    that went with everything below because their shared bits differ too much.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        low = high = self.codes
        self.levels = [(~(low ^ high), low)]             # (mask of shared bits, those bits)
        while len(low) > FAN:
            at = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            self.levels.append((~(low ^ high), low))
        self.looked = self.dropped = 0

    def components(self, most: int) -> Components:
        """Components of the links between fingerprints with at most ``most`` differing bits.

        Pairs of nodes (a <= b) are followed down depth first, ``PAIRS`` at a
        time, so memory is bounded whatever the group looks like.
        """
        n = len(self.codes)
        out = Components(n)
        a, b = np.triu_indices(len(self.levels[-1][0]))
        todo = [(len(self.levels) - 1, a, b, np.zeros(len(a), np.uint64), np.zeros(len(a), np.int64))]
        while todo:
            depth, *pairs = todo.pop()
            if len(pairs[0]) > PAIRS:
                todo.append((depth, *(x[PAIRS:] for x in pairs)))
                pairs = [x[:PAIRS] for x in pairs]
            a, b, done, differ = pairs
            mask, bits = self.levels[depth]
            joint = mask[a] & mask[b]
            differ = differ + np.bitwise_count((bits[a] ^ bits[b]) & joint & ~done)   # bits not compared above
            near = differ <= most
            if depth:
                self.looked += len(a)
                self.dropped += len(a) - int(near.sum())
            at = np.arange(0, n, FAN ** depth)
            least, top = np.minimum.reduceat(out.root, at), np.maximum.reduceat(out.root, at)
            keep = near & ((least[a] != top[b]) | (least[b] != top[a]))   # else one component already
            a, b, done, differ = a[keep], b[keep], joint[keep], differ[keep]
            if not depth:
                out.link(a, b)
            elif len(a):
                size = len(self.levels[depth - 1][0])
                ca = (a[:, None] * FAN + np.repeat(np.arange(FAN), FAN)).ravel()
                cb = (b[:, None] * FAN + np.tile(np.arange(FAN), FAN)).ravel()
                ok = (cb < size) & (ca <= cb)
                todo.append((depth - 1, ca[ok], cb[ok],
                             np.repeat(done, FAN * FAN)[ok], np.repeat(differ, FAN * FAN)[ok]))
        return out


def link_group(codes: np.ndarray, most: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) for the fingerprints of a group that are linked to another."""
    index = Index(codes)
    root = index.components(most).root
    moved = np.flatnonzero(root != np.arange(len(root)))
    return index.codes[moved], index.codes[root[moved]]


# -- links over all fingerprints -------------------------------------------

def masks(n: int, max_distance: int = MAX_DISTANCE, group: int = GROUP) -> list[int]:
    """Bit masks such that fingerprints within the distance agree under one.

    The 64 bits are cut into ``max_distance + k`` blocks; every choice of k
    blocks is a mask, of as many low bits of each as give n random fingerprints
    groups of about ``group``, and k is the least that can. Groups are as large
    as the index wants them, which keeps the masks, and so the rows, few:
    5 up to 4 million fingerprints and 15 up to 10^9 at a distance of 4.
    """
    need = max(0, -(-n // group) - 1).bit_length()
    if not need:
        return [0]
    for k in range(1, 65 - max_distance):
        cuts = [64 * i // (max_distance + k) for i in range(max_distance + k + 1)]
        width = -(-need // k)
        if width <= min(j - i for i, j in zip(cuts, cuts[1:])):
            return [sum(((1 << width) - 1) << c for c in chosen) for chosen in combinations(cuts[:-1], k)]
    return [0]


def near_links(fps: DataFrame, n: int, max_distance: int = MAX_DISTANCE, most: int = MOST) -> DataFrame:
    """fp, root: links between the distinct fingerprints of ``fps`` that give their components."""
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(
        F.lit(m - (1 << 64) if m >> 63 else m)).alias("v")) for t, m in enumerate(masks(n, max_distance))])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.v")
    sizes = C.stored(rows.groupBy("t", "v").count().where(F.col("count") > 1), "group-sizes")
    large = sizes.where(F.col("count") > most).withColumn("chunks", F.ceil(F.col("count") / most).cast("int"))
    if large.isEmpty():
        rows = rows.withColumns({"p": F.lit(0), "q": F.lit(0)})
    else:
        rows = rows.join(large.drop("count"), ["t", "v"], "left")
        n_chunks = F.coalesce("chunks", F.lit(1))
        rows = rows.withColumn("c", F.pmod(F.xxhash64("fp"), n_chunks).cast("int")).withColumn(
            "o", F.explode(F.sequence(F.lit(0), n_chunks - 1)))
        rows = rows.select("fp", "t", "v", F.least("c", "o").alias("p"), F.greatest("c", "o").alias("q"))
    dealt = rows.repartition("t", "v", "p", "q").sortWithinPartitions("t", "v", "p", "q")
    return dealt.select("t", "v", "p", "q", "fp").mapInArrow(_linker(max_distance), "fp bigint, root bigint").distinct()


def _linker(most: int):
    def flush(parts: list[np.ndarray]) -> pa.RecordBatch | None:
        codes = np.concatenate(parts)
        if len(codes) < 2:
            return None
        fp, root = link_group(codes.view(np.uint64), most)
        if not len(fp):
            return None
        return pa.RecordBatch.from_arrays([pa.array(C.signed(fp)), pa.array(C.signed(root))], ["fp", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, key = [], None
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            fp = np.ascontiguousarray(cols[4])
            change = np.zeros(len(fp), bool)
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), len(fp)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                now = tuple(int(c[i]) for c in cols[:4])
                if now != key and parts:
                    found = flush(parts)
                    if found is not None:
                        yield found
                    parts = []
                key = now
                parts.append(fp[i:j])
        if parts:
            found = flush(parts)
            if found is not None:
                yield found
    return run


def components(links: DataFrame) -> DataFrame:
    """fp, c: the smallest fingerprint of the component of every linked one."""
    links = C.stored(links, "links")
    both = links.select(F.col("fp").alias("u"), F.col("root").alias("v"))
    both = C.stored(both.union(both.select("v", "u")), "both")
    labels = C.stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("c")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("c").alias("m"))
        better = C.stored(labels.join(near, "u").select("u", F.least("c", "m").alias("c"), F.col("c").alias("old")), "step")
        up = better.select(F.col("u").alias("c"), F.col("c").alias("cc"))
        labels = C.stored(better.join(up, "c").select("u", F.least("c", "cc").alias("c"), "old"), "jump")
        if labels.where(F.col("c") != F.col("old")).isEmpty():
            return labels.select(F.col("u").alias("fp"), "c")
        labels = labels.select("u", "c")


def near_components(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    most: int = MOST) -> DataFrame:
    """doc_id, d, th, fp, component: struct(d, th) of the smallest document reachable."""
    rows = C.stored(fingerprints(docs, shingle), "fingerprints")
    fps = C.stored(rows.groupBy("fp").agg(F.min(F.struct("d", "th")).alias("first")), "distinct")
    linked = components(near_links(fps, fps.count(), max_distance, most)).join(fps, "fp")
    linked = C.stored(linked, "linked")
    firsts = C.stored(linked.groupBy("c").agg(F.min("first").alias("component")), "firsts")
    linked = linked.join(firsts, "c").select("fp", "component")
    of = C.stored(fps.join(linked, "fp", "left").select("fp", F.coalesce("component", "first").alias("component")), "of")
    return rows.join(of, "fp")


def query(spark, sf_dir: str) -> DataFrame:
    rows = near_components(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    smallest = F.col("component")["d"]
    return rows.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(smallest != C.NULL_KEY, smallest).alias("component_id"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the smallest id, then the smallest text hash."""
    rows = near_components(docs.select("doc_id", "text"))
    keep = rows.where(F.struct("d", "th") == F.col("component")).select(
        F.col("d").alias("__d"), F.col("th").alias("__th")).distinct()
    keep = C.stored(keep, "kept")
    rows = docs.withColumn("__d", C.doc_key()).withColumn("__th", C.row_key())
    rows = C.by_key(rows, keep, ["__d", "__th"], "left_semi")
    one = Window.partitionBy("__d", "__th").orderBy(F.lit(1))
    return rows.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*[F.col(c) for c in docs.columns])
