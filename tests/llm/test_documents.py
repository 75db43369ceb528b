"""SimHash, winnowing, decontamination, quality and packing."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from raincheck.llm import best_fit, decontaminate, quality_gam, simhash_dedup, winnowing

LOW = -(1 << 63)


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


# -- simhash

def brute_fp(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(codes, most):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("most", [8192, 2])
def test_simhash(messy, pairs, most):
    fps = [brute_fp(t) for _, t in pairs]
    r = roots(fps, 4)
    least = {}
    for (i, _), c in zip(pairs, r):
        least[c] = min(least.get(c, 1 << 62), LOW if i is None else i)
    want = sorted((str(i), "%016x" % f, least[c]) for (i, _), f, c in zip(pairs, fps, r))
    got = simhash_dedup.near_components(messy, most=most).collect()
    assert sorted((str(g["doc_id"]), "%016x" % (g["fp"] % (1 << 64)), g["component"]["d"]) for g in got) == want


def test_simhash_stage_keeps_one_of_each(messy, pairs):
    out = simhash_dedup.stage(None, messy, None)
    assert out.columns == messy.columns
    assert out.count() == len(set(roots([brute_fp(t) for _, t in pairs], 4)))


def test_index_finds_all_links():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    near = [base]
    for _ in range(30):
        x = base.copy()
        for _ in range(3):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        near.append(x)
    codes = np.unique(np.concatenate([*near, rng.integers(0, 1 << 63, 900).astype(np.uint64)]))
    for n in (1, 2, 3, 5, 33, len(codes)):
        part = rng.permutation(codes)[:n]
        fp, root = simhash_dedup.link_group(part, 4)
        got = dict(zip(fp.tolist(), root.tolist()))
        groups = {}
        for c, r in zip(part.tolist(), roots(part.tolist(), 4)):
            groups.setdefault(r, set()).add(c)
        mine = {}
        for c in part.tolist():
            mine.setdefault(got.get(c, c), set()).add(c)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


@pytest.mark.parametrize("pairs", [7, simhash_dedup.PAIRS])
def test_index_links_a_dense_group_in_bounded_steps(monkeypatch, pairs):
    monkeypatch.setattr(simhash_dedup, "PAIRS", pairs)
    fp, root = simhash_dedup.link_group(np.arange(1024, dtype=np.uint64), 1)    # a chain through all of them
    assert len(fp) == 1023 and len(set(root.tolist())) == 1


def test_index_prunes_on_the_given_texts(llm_spark):
    """The masks leave large groups of a real table, most pairs in them go unread, and no link is lost."""
    docs = llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    codes = np.unique(np.array([r["fp"] for r in simhash_dedup.fingerprints(docs).select("fp").collect()],
                               np.int64).view(np.uint64))
    singles = looked = dropped = largest = 0
    found = set()
    for m in simhash_dedup.masks(len(codes)):
        keys = codes & np.uint64(m)
        for v in np.unique(keys):
            index = simhash_dedup.Index(codes[keys == v])
            root = index.components(4).root
            n = len(root)
            singles, looked, dropped = singles + n * (n - 1) // 2, looked + index.looked, dropped + index.dropped
            largest = max(largest, n)
            moved = np.flatnonzero(root != np.arange(n))
            found |= set(index.codes[moved].tolist()) | set(index.codes[root[moved]].tolist())
    assert largest > 256 and dropped > 0 and looked < singles / 2
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    np.fill_diagonal(apart, 64)
    assert found == set(codes[apart.min(axis=1) <= 4].tolist())


@pytest.mark.parametrize("n,distance", [(0, 4), (10, 4), (5000, 4), (10 ** 7, 4), (10 ** 10, 4), (1000, 1), (1000, 10)])
def test_masks_meet_all_near_pairs(n, distance):
    rng = np.random.default_rng(n % 97)
    masks = simhash_dedup.masks(n, distance)
    for _ in range(300):
        x = sum(1 << int(b) for b in rng.choice(64, distance, replace=False))
        assert any(not x & m for m in masks)


# -- winnowing

def test_winnowing_next_and_likeness(messy, pairs):
    got = winnowing.with_next(messy, run_rows=4).collect()
    order = sorted(pairs, key=lambda p: (LOW if p[0] is None else p[0]))
    assert len(got) == len(order)
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(i), t or "") for i, t in pairs)
    unique = {i for i, _ in order if i is not None} - {17, 18, 23}      # these meet ties
    follow = {order[k][0]: order[(k + 1) % len(order)][1] or "" for k in range(len(order))}
    for r in got:
        if r["doc_id"] in unique:
            assert r["next_text"] == follow[r["doc_id"]]
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]
        assert by_text.setdefault(r["next_text"], r["next_fingerprint"]) == r["next_fingerprint"]


def brute_chars(t, k, w):
    """Positions of the chosen k-grams, and the k-grams."""
    c = re.sub(r"[ \t-\r]", "", t or "")
    if len(c) < k:
        return ([0], [c]) if c else ([], [])
    grams = [c[i:i + k] for i in range(len(c) - k + 1)]
    h = [-((xxhash.xxh64_intdigest(g.encode(), 42) ^ 1 << 63) >> 32) for g in grams]      # stored complemented
    picks = []
    for a in range(max(1, len(h) - w + 1)):
        part = h[a:a + w]
        at = a + max(j for j, x in enumerate(part) if x == min(part))
        if at not in picks[-1:]:
            picks.append(at)
    return picks, [grams[p] for p in picks]


@pytest.mark.parametrize("chunk, k, w", [(4096, winnowing.CHARS, winnowing.CHAR_WINDOW), (7, 5, 6), (3, 5, 1)])
def test_winnowing_takes_a_gram_at_every_character(messy, monkeypatch, chunk, k, w):
    monkeypatch.setattr(winnowing, "_CHUNK", chunk)
    short = messy.where(F.coalesce(F.length("text"), F.lit(0)) < 30_000)
    for r in winnowing.with_char_fingerprint(short, "text", "fp", k, w).select("text", "fp").collect():
        picks, grams = brute_chars(r["text"], k, w)
        assert [x & 0xFFFFFFFF for x in r["fp"]] == picks
        assert [x >> 32 & 0xFFFFFFFF for x in r["fp"]] == [xxhash.xxh64_intdigest(g.encode(), 42) >> 32 for g in grams]


@pytest.mark.parametrize("chunk, k, w", [(4096, winnowing.CHARS, winnowing.CHAR_WINDOW), (7, 5, 6)])
def test_winnowing_of_the_edited_text(messy, pairs, monkeypatch, chunk, k, w):
    """Every text with short, blank, long and empty ones after it: the same as from the edited text alone."""
    monkeypatch.setattr(winnowing, "_CHUNK", chunk)
    texts = [t[:600] for _, t in pairs if t is not None] + ["a b c d" * 3, "x" * 21, " " * 40 + "y" * 16, "z" * 15]
    spark = messy.sparkSession
    df = spark.createDataFrame([(t, texts[(i + s) % len(texts)]) for i, t in enumerate(texts) for s in (1, 2, 5)],
                               "text string, next_text string")
    df = winnowing.with_both_fingerprints(df, k, w)
    df = winnowing.with_char_fingerprint(df, "edited", "want", k, w)
    rows = winnowing.with_char_fingerprint(df, "text", "own", k, w).collect()
    assert len(rows) == 3 * len(texts)
    for r in rows:
        cut = len(r["text"]) // 4
        assert r["edited"] == r["text"][:len(r["text"]) - cut] + r["next_text"][:cut]
        assert r["fingerprint"] == r["own"] and r["edited_fingerprint"] == r["want"]
        assert [x & 0xFFFFFFFF for x in r["want"]] == brute_chars(r["edited"], k, w)[0]


def test_winnowing_finds_shared_passages_at_any_offset(llm_spark):
    rng = np.random.default_rng(3)

    def run(n):
        return "".join(chr(x) for x in rng.integers(0x4E00, 0x9FA5, n))
    least = winnowing.CHARS + winnowing.CHAR_WINDOW - 1
    shared, whole = run(least), run(2_000)
    texts = [(i, run(40 + i) + shared + run(50)) for i in range(17)] + [(100, whole), (101, "x" + whole)]
    docs = llm_spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in winnowing.with_next(docs).select(
        "doc_id", winnowing.hashes(F.col("fingerprint")).alias("h"),
        winnowing.likeness(winnowing.hashes(F.col("fingerprint")),
                           winnowing.hashes(F.col("next_fingerprint"))).alias("near")).collect()}
    assert set.intersection(*(set(got[i]["h"]) for i in range(17)))
    assert got[100]["near"] > 0.95


@pytest.mark.parametrize("hot", [None, 0, 1500, 5000])
def test_winnowing_spreads_a_hot_id(llm_spark, hot):
    """A third of the rows under one id: no run holds much more than the others, and no row loses its next one."""
    rows = [(hot if i % 3 == 0 else i, f"text {i * 7919 % 3001} {i}") for i in range(3000)]
    docs = llm_spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    d, th = winnowing.doc_key(), winnowing.row_key()
    run = winnowing._runs(docs.select(d.alias("__d")), 50, d, th)
    sizes = docs.groupBy(run.alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(d, th)).alias("a"), F.max(F.struct(d, th)).alias("b")).orderBy("run").collect()
    assert max(r["n"] for r in sizes) <= 150
    assert all(x["b"] < y["a"] for x, y in zip(sizes, sizes[1:]))
    hashed = docs.select("doc_id", "text", d.alias("d"), th.alias("th")).collect()
    order = [r["text"] for r in sorted(hashed, key=lambda r: (r["d"], r["th"]))]
    got = winnowing.with_next(docs, run_rows=50).select("text", "next_text").collect()
    assert sorted((r["text"], r["next_text"]) for r in got) == sorted(zip(order, order[1:] + order[:1]))


def test_winnowing_empty(nothing):
    assert winnowing.with_next(nothing).collect() == []


# -- decontamination

def brute_hits(docs, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = {}
    for i, t in items:
        w = re.findall(pattern, lower(t))
        for p in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[p:p + 10]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w = re.findall(pattern, lower(t))
        hit, ids = set(), set()
        for m in {len(x) for x in windows}:
            for p in range(len(w) - m + 1):
                found = windows.get(tuple(w[p:p + m]))
                if found:
                    hit.update(range(p, p + m))
                    ids |= found
        out.append((i, len(w), tuple(sorted(hit)), tuple(sorted(ids))))
    return sorted(out, key=str)


def bench_rows(pairs):
    text = dict(pairs)
    passage = text[10].split(" ")
    return [(1, " ".join(passage[5:30]).upper()), (2, "word"), (3, None), (4, ""), (None, " ".join(passage[40:52])),
            (5, text[18][:40]), (5, text[18][:40]), (6, "nothing of the kind at all"), (7, "same same"), (8, "!!")]


@pytest.mark.parametrize("block", [200_000, 3])
def test_decontamination(llm_spark, messy, pairs, block):
    items = bench_rows(pairs)
    bench = llm_spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.match_benchmark(messy, bench, out="found", max_patterns=block)
    assert got.columns == [*messy.columns, "found"]
    rows = sorted(((r["doc_id"], r["found"]["n_words"], tuple(r["found"]["hit_words"]), tuple(r["found"]["items"]))
                   for r in got.collect()), key=str)
    assert rows == brute_hits(pairs, items)


def test_decontamination_bounds_blocks_by_bytes(llm_spark, messy, pairs, monkeypatch):
    items = bench_rows(pairs) + [(9, "y" * 5000 + " z")]
    bench = llm_spark.createDataFrame(items, "item_id bigint, text string").repartition(4)
    whole = decontaminate.match_benchmark(messy, bench, out="found")
    sizes, real = [], decontaminate.read_block
    monkeypatch.setattr(decontaminate, "read_block", lambda rows, k, n: sizes.append((k, n)) or real(rows, k, n))
    blocks = decontaminate.match_benchmark(messy, bench, out="found", max_bytes=2_500)
    assert sorted(k for k, _ in sizes) == list(range(sizes[0][1])) and len(sizes) >= 3
    assert blocks.schema["found"].dataType.fieldNames() == whole.schema["found"].dataType.fieldNames()
    assert sorted(map(str, blocks.collect())) == sorted(map(str, whole.collect()))


def test_decontamination_empty(llm_spark, messy, nothing):
    none = llm_spark.createDataFrame([], "item_id bigint, text string")
    assert all(r["hits_"]["hit_words"] == [] for r in decontaminate.match_benchmark(messy, none, out="hits_").collect())
    assert decontaminate.match_benchmark(nothing, none, out="hits_").collect() == []


# -- quality

def test_quality_learns_and_keeps_clean(llm_spark, messy, nothing):
    rows = []
    for i in range(600):
        good = i % 3 > 0
        w = ["the", "of", "and", "water", "stone", "light", "river"][i % 5:]
        rows.append((i, (" ".join(w) + ". ") * 6 if good else " ".join(x + "%%%" for x in w) * 6, int(good)))
    docs = llm_spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = llm_spark.createDataFrame([(r[0], r[2], None) for r in rows] + [(None, 1, 0), (3, None, 0), (10 ** 6, 1, 0)],
                                       "doc_id bigint, quality int, toxic int")
    model = quality_gam.train(docs, labels)
    got = quality_gam.score(docs, model).withColumn("held", quality_gam.held_out()).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r["held"]]
    assert len(held) > 50 and all((r["score"] >= 0.3) == bool(truth[r["doc_id"]]) for r in held)
    out = quality_gam.score(messy, model, "quality_score")
    assert out.columns == [*messy.columns, "quality_score"]
    assert all(0 <= r["quality_score"] <= 1 for r in out.collect())
    assert quality_gam.score(nothing, model, "quality_score").collect() == []


def test_quality_without_labels(llm_spark, messy):
    none = llm_spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = quality_gam.train(messy, none)
    assert {r["s"] for r in quality_gam.score(messy, model, "s").collect()} == {0.5}
    one = llm_spark.createDataFrame([(i, 1, 0) for i in range(1, 20)], "doc_id bigint, quality int, toxic int")
    assert all(r["s"] > 0.8 for r in quality_gam.score(messy, quality_gam.train(messy, one), "s").collect())


def test_quality_learns_one_row_of_a_repeated_id(llm_spark, monkeypatch):
    seen = []

    class Recorder:
        def __init__(self, x, y):
            seen.append((x, y))
    monkeypatch.setattr(quality_gam, "Model", Recorder)
    labels = llm_spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    docs = llm_spark.createDataFrame([(i, "word " * (i + 1)) for i in range(40)], "doc_id bigint, text string")
    ids = sorted(r[0] for r in labels.where(~quality_gam.held_out()).collect())
    copies = docs.where(F.col("doc_id") == ids[0]).crossJoin(llm_spark.range(300)).select("doc_id", "text")
    quality_gam.train(docs, labels)
    quality_gam.train(docs.unionByName(copies), labels)
    assert [len(y) for _, y in seen] == [len(ids)] * 2
    assert all(np.array_equal(a, b) for a, b in zip(*seen))
    # Different texts under one id: one of them, whatever the order of the rows.
    other = copies.withColumn("text", F.concat("text", F.expr("uuid()"))).collect()
    for rows in (other, other[::-1]):
        quality_gam.train(docs.unionByName(llm_spark.createDataFrame(rows, docs.schema)), labels, max_rows=10)
    assert [len(y) for _, y in seen[2:]] == [10] * 2
    assert all(np.array_equal(a, b) for a, b in zip(*seen[2:]))


def test_quality_held_out_accuracy(llm_spark, small_sf):
    sf = small_sf.replace("0.001", "0.01")
    rows = quality_gam.query(llm_spark, sf).join(llm_spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    held = rows.where("held_out").select("predicted", "quality").collect()
    assert np.mean([r[0] == r[1] for r in held]) > 0.95


# -- packing

def plain_best_fit(lengths, sizes, fixed, preferred):
    bins, remaining, where = [], sum(lengths), []
    for n in lengths:
        fitting = [(c - u, k) for k, (c, u) in enumerate(bins) if c - u >= n]
        if fitting:
            room = min(fitting)[0]
            k = max(k for r, k in fitting if r == room)
        else:
            k = len(bins)
            bins.append((best_fit._open_size(n, remaining, sizes, fixed, preferred), 0))
        where.append(n)
        bins[k] = (bins[k][0], bins[k][1] + n)
        remaining -= n
    return sum(min(s for s in sizes if s >= u) + fixed for _, u in bins)


def test_best_fit_cost_is_that_of_a_plain_search():
    rng = np.random.default_rng(5)
    for _ in range(20):
        sizes = (64, 128, 256)
        lengths = sorted(rng.integers(1, 257, rng.integers(1, 80)).tolist(), reverse=True)
        for preferred in (None, *sizes):
            _, _, final, cost = best_fit.pack_once(lengths, sizes, 8, preferred)
            assert abs(cost - plain_best_fit(lengths, sizes, 8, preferred)) <= 0.02 * cost
        assert best_fit.pack(lengths, sizes, 8)[3] == min(
            best_fit.pack_once(lengths, sizes, 8, p)[3] for p in (None, *sizes))


@pytest.mark.parametrize("shard", [10_000, 4])
def test_packing_is_whole_and_fits(messy, pairs, shard):
    rows = best_fit.pack_documents(messy, sizes=(64, 128, 512), shard_rows=shard).collect()
    total = {}
    for i, t in pairs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        total[i] = total.get(i, 0) + n
    got = {}
    bins = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_tokens"]
        assert (r["bin_id"] is None) == (r["n_tokens"] == 0)
        if r["bin_id"]:
            bins.setdefault(r["bin_id"], []).append(r)
    assert got == total
    for parts in bins.values():
        size, used = parts[0]["bin_size"], sum(p["n_tokens"] for p in parts)
        assert used <= size and not any(s >= used for s in (64, 128, 512) if s < size)
        at = 0
        for p in sorted(parts, key=lambda p: p["bin_offset"]):
            assert p["bin_offset"] == at
            at += p["n_tokens"]


def test_packing_deals_copies_over_shards(llm_spark):
    """Two thirds of the rows are one row: its copies spread over the shards, none is lost."""
    rows = [(5, "a b c")] * 6000 + [(k, "w " * (k % 50)) for k in range(100, 3100)]
    df = llm_spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = best_fit.pack_documents(df, sizes=(64, 128), shard_rows=300).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == sorted((d, len(t.split())) for d, t in rows)
    shards = {}
    for r in got:
        if r["doc_id"] == 5:
            shard = r["bin_id"].split("-")[0]
            shards[shard] = shards.get(shard, 0) + 1
    assert len(shards) >= 25 and max(shards.values()) < 6000 / 5
    used = {}
    for r in got:
        if r["bin_id"] is not None:
            used.setdefault(r["bin_id"], []).append((r["bin_offset"], r["n_tokens"], r["bin_size"]))
    for pieces in used.values():
        at = 0
        for offset, n, size in sorted(pieces):
            assert offset == at
            at += n
        assert at <= size


def test_packing_empty(nothing):
    assert best_fit.pack_documents(nothing).collect() == []


