"""Prefix trie of conversations by the Euler-tour technique.

Operator 13. A node of the trie is a distinct sequence of first turns; its
members are the conversations that start with it. What a subtree holds (leaves,
savings) comes from prefix sums along the Euler tour: every node has an enter
and an exit arc, the tour is the linked list of all arcs, and once each arc
knows the sums up to its place, a subtree's sum is the difference of its node's
two arcs, however deep or wide the subtree is.

1. *Nodes.* A turn hashes to 128 bits; a node is named by the exclusive or of
   its turns' hashes, each salted with its depth, which a running window gives,
   so no row ever holds a whole conversation. Nodes are a grouping of these rows
   (map-side combine: the root and a common first turn are one row a task).
2. *Links.* Siblings are linked in three levels: within (parent, first two bytes
   of the name), then these segments within (parent, first byte), then within
   the parent. No window holds more than a 65,536th of a crowded node's children
   or 256 segments.
3. *List ranking.* Nodes are range-partitioned by their first three turns, so
   most arcs have their successor in the same partition. Each partition ranks
   its pieces of the list (pointer doubling on arrays) and sends one row per
   piece; the pieces, a few per partition, are ranked by pointer doubling in
   Spark joins on written tables; a last join adds a piece's rest to its arcs.
   Any partitioning gives the same sums; a bad one only leaves more pieces.

``ends_sha256`` hashes one text per node, in order: ids are sorted over all
tasks and joined to chunks there, so that the task which must read a node's
chunks in order reads few rows and keeps only the hash's state.

Defined results: null role or text: empty; a null conv_id is one conversation of
its own, kept as it is, before all others and written ``null`` among the ends;
turns sort by (turn, nulls first, hash of the turn), so ties and repeated rows
have a fixed order; repeated rows are turns of their own; texts of any length
are only hashed and measured; an empty table gives the root alone, with no
members; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raincheck.llm.common import NULL_KEY, by_key, stored

#: Fixed by the contract: the group of ids that share a start, and the most turns of it plus one.
GROUP, STARTS = 5, 9
ROOT = bytes(16)
ENTER, EXIT = 0, 1
#: Bytes of ids that one chunk of a node's ends holds.
CHUNK = 1 << 20

RANKED = "head boolean, side int, node binary, next_side int, next binary, arcs bigint, leaves bigint, saved bigint"
CHUNKS = "node binary, first bigint, ids string"


def name_of(a: Column, b: Column) -> Column:
    """Two 64-bit halves as a node's 16 bytes."""
    return F.unhex(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def hashed(turns: DataFrame) -> DataFrame:
    """Turns without their texts: conv_id, place, two hashes, bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), role, text).alias("h2"),
                        F.octet_length(text).cast("bigint").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "h1", "h2")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), "h1", "h2", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: (all conv_ids, their turns by place)."""
    rows = stored(hashed(turns), "trie-turns")
    c = F.col("conv_id")
    convs = rows.groupBy("conv_id").agg(F.max("place").alias("n")).select(
        "conv_id", (c - c % GROUP).alias("start"), F.coalesce(F.crc32(c.cast("string")) % STARTS, F.lit(0)).alias("h"))
    begun = convs.where("h > 0 AND start IS NOT NULL").alias("c").join(
        rows.where(F.col("place") < STARTS).alias("r"),
        (F.col("c.start") == F.col("r.conv_id")) & (F.col("r.place") <= F.col("c.h"))).select(
        "c.conv_id", "place", "h1", "h2", "bytes")
    # After its first h turns; the start, if any, took at most h places.
    h = F.coalesce(F.crc32(c.cast("string")) % STARTS, F.lit(0))
    own = rows.where(F.col("place") > h)
    return convs.select("conv_id"), begun.unionByName(own)


def steps(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth: the node it passes there."""
    w = Window.partitionBy("conv_id")
    placed = turns.withColumn("depth", F.row_number().over(w.orderBy("place")).cast("bigint"))
    salted = placed.select("conv_id", "depth", "bytes", F.xxhash64("h1", "h2", "depth").alias("s1"),
                           F.xxhash64(F.lit(1), "h1", "h2", "depth").alias("s2"))
    so_far = w.orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = salted.select(
        "*", F.bit_xor("s1").over(so_far).alias("k1"), F.bit_xor("s2").over(so_far).alias("k2"),
        F.lead("depth").over(w.orderBy("depth")).isNull().alias("ends"))
    early = [F.max(F.when(F.col("depth") == d, F.col("k1"))).over(
        w.orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"a{d}") for d in (1, 2, 3)]
    return named.select(
        "conv_id", "depth", "bytes", "ends", name_of(F.col("k1"), F.col("k2")).alias("node"),
        name_of(F.col("k1").bitwiseXOR(F.col("s1")), F.col("k2").bitwiseXOR(F.col("s2"))).alias("parent"), *early)


def linked(nodes: DataFrame) -> DataFrame:
    """Per node: children, the first of them, the next sibling."""
    inner = nodes.where("depth > 0")
    at, links = inner.select("parent", F.col("node").alias("first"), F.col("node").alias("last")), None
    for width in (2, 1, 0):
        group = ["parent", *([F.substring("first", 1, width).alias("part")] if width else [])]
        cut = at.select(*group, "first", "last")
        keys = [c for c in ("parent", "part") if c in cut.columns]
        seen = cut.withColumn("next", F.lead("first").over(Window.partitionBy(*keys).orderBy("first")))
        found = seen.where("next IS NOT NULL").select(F.col("last").alias("node"), "next")
        links = found if links is None else links.unionByName(found)
        at = cut.groupBy(*keys).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    nothing = F.lit(None)
    below = inner.groupBy("parent").agg(F.count("*").alias("n_children"), F.min("node").alias("first_child")).select(
        F.col("parent").alias("node"), "n_children", "first_child", nothing.cast("binary").alias("next"))
    return below.unionByName(links.select(
        "node", nothing.cast("bigint").alias("n_children"), nothing.cast("binary").alias("first_child"), "next")) \
        .groupBy("node").agg(F.max("n_children").alias("n_children"), F.max("first_child").alias("first_child"),
                             F.max("next").alias("next"))


def rank_pieces(nodes: pa.Table) -> pa.RecordBatch:
    """Ranks the arcs of one partition's nodes as far as their list stays inside.

    Per arc: sums from it to the end of its piece, and where the list goes on;
    per piece the same again, marked ``head``.
    """
    n = nodes.num_rows
    node, parent, child, after = (nodes.column(c).combine_chunks() for c in ("node", "parent", "first_child", "next"))

    def local(keys: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(keys, value_set=node), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    has_child, has_after = (c.is_valid().to_numpy(zero_copy_only=False) for c in (child, after))
    own = np.arange(n, dtype=np.int64)
    up, down, side = local(parent), local(child), local(after)
    follow = np.concatenate([np.where(has_child, down, n + own),
                             np.where(has_after, side, np.where(up >= 0, n + up, -1))])
    worth = np.zeros((2 * n, 3), np.int64)
    worth[:, 0] = 1
    worth[:n, 1] = ~has_child
    worth[:n, 2] = nodes.column("saved").to_numpy()
    last = follow < 0
    head = np.ones(2 * n, bool)
    head[follow[~last]] = False
    to = np.where(last, np.arange(2 * n), follow)
    total = np.where(last[:, None], 0, worth)
    while True:                               # to: the arc reached so far; total: sums before it
        total = total + total[to]
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    total = total + worth[to]
    # Where the list goes on after the last arc of a piece: a child, a sibling, or the parent's exit.
    outside = pa.chunked_array([child, pc.if_else(after.is_valid(), after, parent)]).combine_chunks()
    enters = np.concatenate([np.full(n, ENTER), np.where(has_after, ENTER, EXIT)])
    arcs = np.arange(2 * n)
    rows = np.concatenate([arcs, arcs[head]])
    ids = pa.chunked_array([node, node]).combine_chunks()
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([np.zeros(2 * n, bool), np.ones(int(head.sum()), bool)])),
        pa.array((rows >= n).astype(np.int32)), ids.take(pa.array(rows)),
        pa.array(enters[to[rows]].astype(np.int32)), outside.take(pa.array(to[rows])),
        *(pa.array(total[rows, k]) for k in range(3))],
        ["head", "side", "node", "next_side", "next", "arcs", "leaves", "saved"])


def ranked(tree: DataFrame) -> DataFrame:
    """Per node: places of its two arcs from the tour's end, leaves and savings below it."""
    dealt = tree.select("node", "parent", "first_child", "next", "saved", "a1", "a2", "a3", "conv_id", "depth") \
        .repartitionByRange("a1", "a2", "a3", "conv_id", "depth").select("node", "parent", "first_child", "next", "saved")

    def run(batches):
        kept = [b for b in batches if b.num_rows]
        if kept:
            yield rank_pieces(pa.Table.from_batches(kept))

    arcs = stored(dealt.mapInArrow(run, RANKED), "trie-arcs")
    sums = ["arcs", "leaves", "saved"]
    pieces = arcs.where("head").drop("head")
    # Pointer doubling: each round a piece adds what its successor knows and skips to where that one points.
    while not pieces.where("next IS NOT NULL").isEmpty():
        p, q = pieces.alias("p"), pieces.alias("q")
        pieces = stored(p.join(q, (F.col("p.next") == F.col("q.node")) & (F.col("p.next_side") == F.col("q.side")), "left")
                        .select("p.side", "p.node", "q.next_side", "q.next",
                                *((F.col(f"p.{s}") + F.coalesce(F.col(f"q.{s}"), F.lit(0))).alias(s) for s in sums)),
                        "trie-pieces")
    a, p = arcs.where("NOT head").alias("a"), pieces.alias("p")
    whole = a.join(p, (F.col("a.next") == F.col("p.node")) & (F.col("a.next_side") == F.col("p.side")), "left").select(
        "a.node", "a.side", *((F.col(f"a.{s}") + F.coalesce(F.col(f"p.{s}"), F.lit(0))).alias(s) for s in sums))
    enter = F.col("side") == ENTER
    return whole.groupBy("node").agg(
        F.max(F.when(enter, F.col("arcs"))).alias("enter"), F.max(F.when(~enter, F.col("arcs"))).alias("exit"),
        *(F.sum(F.when(enter, F.col(s)).otherwise(-F.col(s))).alias(f"{s}_below") for s in ("leaves", "saved")))


def ends_digest(ends: DataFrame) -> DataFrame:
    """Per node: SHA-256 of the ids that end there, ascending, comma-joined."""

    def join_ids(batches):
        now, first, ids, size = None, None, [], 0
        for batch in batches:
            out = []
            for node, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (node != now or size > CHUNK):
                    out.append((now, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    now, first = node, conv
                ids.append("null" if conv == NULL_KEY else str(conv))
                size += len(ids[-1])
            yield from _rows(out, ["node", "first", "ids"])
        yield from _rows([(now, first, ",".join(ids))] if ids else [], ["node", "first", "ids"])

    def digest(batches):
        now, state = None, None
        for batch in batches:
            out = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if state is None or node != now:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256()
                    state.update(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield from _rows(out, ["node", "ends_sha256"])
        yield from _rows([(now, state.hexdigest())] if state else [], ["node", "ends_sha256"])

    chunks = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(join_ids, CHUNKS)
    return chunks.repartition("node").sortWithinPartitions("node", "first") \
        .mapInArrow(digest, "node binary, ends_sha256 string")


def _rows(rows: list[tuple], names: list[str]):
    if rows:
        types = {"node": pa.binary(), "first": pa.int64()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, types.get(k, pa.string())) for k, c in zip(names, zip(*rows, strict=True), strict=True)], names)


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, place, h1, h2, bytes), the
    root for all ``convs`` included: node and parent names, conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    enter and exit (places of its arcs in the tour), ends_sha256."""
    path = stored(steps(turns), "trie-steps")
    member = F.coalesce("conv_id", F.lit(NULL_KEY))
    met = path.groupBy("node", "parent", "depth").agg(
        F.min(member).alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
        *(F.min(a).alias(a) for a in ("a1", "a2", "a3")))
    zero, nothing = F.lit(0).cast("bigint"), F.lit(None)
    root = convs.agg(F.min(member).alias("conv_id"), F.count("*").alias("n_convs")).select(
        F.lit(ROOT).alias("node"), nothing.cast("binary").alias("parent"), zero.alias("depth"), "conv_id", "n_convs",
        zero.alias("bytes"), *(nothing.cast("bigint").alias(a) for a in ("a1", "a2", "a3")))
    nodes = stored(met.unionByName(root), "trie-nodes")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tree = by_key(by_key(nodes, linked(nodes), ["node"], "left"), above, ["parent"], "left")
    # The root has no turn: it saves nothing, and is no conversation's end but a turnless one's.
    tree = stored(tree.withColumn("n_children", F.coalesce("n_children", zero))
                  .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "trie-tree")
    with_turns = path.where("depth = 1").select("conv_id").alias("t")
    turnless = convs.alias("c").join(with_turns, F.col("c.conv_id").eqNullSafe(F.col("t.conv_id")), "left_anti")
    ends = path.where("ends").select("node", member.alias("conv")).unionByName(
        turnless.select(F.lit(ROOT).alias("node"), member.alias("conv")))
    sums = by_key(ranked(tree), ends_digest(ends), ["node"], "left")
    known = by_key(tree, sums, ["node"])
    return known.select(
        "node", "parent", *(F.when(F.col(c) != NULL_KEY, F.col(c)).alias(c) for c in ("conv_id", "parent_conv_id")),
        "depth", "n_convs", "n_children", F.col("leaves_below").alias("n_leaves"),
        F.col("saved_below").alias("saved_tokens"), "enter", "exit",
        ((F.col("enter") - F.col("exit") + 1) / 2).cast("bigint").alias("n_nodes"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    convs, turns = rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return trie(convs, turns).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                     "saved_tokens", "ends_sha256")


# Nodes by whole chained digests, subtrees by joining every node to its ancestors.
ORACLE = r"""
WITH ids AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS k FROM conversations
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS start, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
    4294967295::BIGINT) % 9 AS h
  FROM ids
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations
), joined AS (
  SELECT c.conv_id, 0 AS part, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.start AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
), marked AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes, md5(role || chr(10) || md5(text)) AS mark
  FROM joined WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
), path AS (
  SELECT conv_id, depth, bytes, md5(string_agg(mark, ',' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS node
  FROM marked
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs
), edges AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
    lead(node) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends
  FROM path
), nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * max(bytes) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM edges GROUP BY node, depth
), fans AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent
), below AS (
  SELECT a.node, sum(CASE WHEN f.node IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM nodes n JOIN path a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN fans f ON f.node = n.node
  GROUP BY a.node
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
  CAST(coalesce(f.n_children, 0) AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN fans f ON f.node = n.node JOIN below b ON b.node = n.node
"""
