"""Line, substring and suffix-array dedup against brute force."""

import hashlib
import os
import re

import numpy as np
import pytest

from raincheck.llm import anchors, line_dedup, substring_dedup, suffix_dedup

LOW = -(1 << 63)


def key(i):
    return LOW if i is None else i


def firsts(docs, units, width):
    """Earliest (doc, place) of every window."""
    out = {}
    for i, t in docs:
        u = units(t)
        for p in range(len(u) - width + 1):
            w = tuple(u[p:p + width])
            out[w] = min(out.get(w, (key(i), p)), (key(i), p))
    return out


def gone(i, u, first, width):
    out = [False] * len(u)
    for p in range(len(u) - width + 1):
        if first[tuple(u[p:p + width])] < (key(i), p):
            out[p:p + width] = [True] * width
    return out


def sha(b):
    return hashlib.sha256(b).hexdigest()


def as_rows(rows):
    return sorted((tuple(r) for r in rows), key=str)


def split_lines(t):
    return [] if t is None else t.split("\n")


def split_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_lines(messy, pairs):
    first = firsts(pairs, split_lines, 3)
    want = []
    for i, t in pairs:
        u = split_lines(t)
        g = gone(i, u, first, 3)
        kept = t if not any(g) else "\n".join(x for x, y in zip(u, g) if not y)
        want.append((i, kept, len(u), sum(g)))
    got = line_dedup.dedup_lines(messy, extra=True).select("doc_id", "text", "__n_lines", "__n_removed").collect()
    assert as_rows(got) == as_rows(want)
    assert any(r[3] for r in got)


def test_lines_keep_the_other_columns(messy):
    out = line_dedup.stage(None, messy, None)
    assert out.schema == messy.schema
    assert out.count() == messy.count()
    assert {r["d"] for r in out.collect()} == {"clash"}


def substring_want(pairs):
    first = firsts(pairs, split_words, 20)
    want = []
    for i, t in pairs:
        u = split_words(t)
        g = gone(i, u, first, 20)
        kept = " ".join(x for x, y in zip(u, g) if not y)
        want.append((i, len(u), sum(g), sha(kept.encode()), kept))
    return want


def test_substrings(messy, pairs):
    got = substring_dedup.dedup_substrings(messy).collect()
    assert as_rows(got) == as_rows(substring_want(pairs))
    assert sum(r["n_removed"] > 0 for r in got) > 5


def bytes_want(pairs, width):
    units = lambda t: list((t or "").encode())
    first = firsts(pairs, units, width)
    want = []
    for i, t in pairs:
        u = units(t)
        g = gone(i, u, first, width)
        kept = bytes(x for x, y in zip(u, g) if not y)
        spans = sum(y and (k == 0 or not g[k - 1]) for k, y in enumerate(g))
        want.append((i, len(u), sum(g), spans, sha(kept), kept))
    return want


@pytest.mark.parametrize("hot,bucket", [(2000, 1_000_000), (0, 3_000)])
def test_bytes(messy, pairs, hot, bucket):
    got = [(*tuple(r)[:5], bytes(r[5])) for r in suffix_dedup.dedup_bytes(messy, hot=hot, bucket_bytes=bucket).collect()]
    assert as_rows(got) == as_rows(bytes_want(pairs, 100))


def test_empty_tables(nothing):
    assert line_dedup.dedup_lines(nothing).collect() == []
    assert substring_dedup.dedup_substrings(nothing).collect() == []
    assert suffix_dedup.dedup_bytes(nothing).collect() == []


def test_symbols_are_the_same_inside_equal_substrings():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 9, 60).astype(np.uint64)
    a = np.concatenate((rng.integers(0, 9, 17).astype(np.uint64), shared, rng.integers(0, 9, 5).astype(np.uint64)))
    b = np.concatenate((rng.integers(0, 9, 4).astype(np.uint64), shared, rng.integers(0, 9, 31).astype(np.uint64)))

    def inside(x, at):
        first = np.array([0, len(x)])
        level = substring_dedup.runs(x, first)
        out = []
        for turn in range(3):
            level = substring_dedup.pairs(level, first, turn)
            ok = (level.dlo >= at) & (level.dhi <= at + len(shared))
            out.append(list(zip(level.name[ok], level.dlo[ok] - at, level.dhi[ok] - at)))
        return out

    assert inside(a, 17) == inside(b, 4)
    assert all(inside(a, 17))


def test_collection_is_the_sorted_suffixes():
    strings = [b"banana", b"ananas", b"", b"band", b"banana"]
    data = np.frombuffer(b"".join(strings), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
    c = suffix_dedup.Collection(data, offsets)
    got = [strings[s][p - offsets[s]:] for s, p in zip(c.string, c.place)]
    assert got == sorted(s[i:] for s in strings for i in range(len(s) + 1))
    before = [strings[s][p - offsets[s] - 1] + 1 if p > offsets[s] else 0 for s, p in zip(c.string, c.place)]
    assert before == c.bwt.tolist()
    assert c.lcp.tolist() == common_prefixes(got)


def common_prefixes(suffixes):
    return [0] + [len(os.path.commonprefix([a, b])) for a, b in zip(suffixes, suffixes[1:])]


@pytest.mark.parametrize("seed, letters, longest", [(0, 2, 40), (1, 3, 12), (2, 1, 20), (3, 256, 300), (4, 2, 300)])
def test_collection_of_random_strings(seed, letters, longest):
    """Order, BWT and common prefixes; with byte 255 and strings over 255 bytes (wider columns)."""
    rng = np.random.default_rng(seed)
    strings = [rng.integers(0, letters, rng.integers(0, longest + 1)).astype(np.uint8).tobytes() for _ in range(25)]
    strings += strings[:3] + [bytes([255]) * longest if letters == 256 else b""]
    data = np.frombuffer(b"".join(strings), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
    c = suffix_dedup.Collection(data, offsets)
    got = [strings[s][p - offsets[s]:] for s, p in zip(c.string, c.place)]
    assert got == sorted(s[i:] for s in strings for i in range(len(s) + 1))
    assert c.bwt.tolist() == [int(data[p - 1]) + 1 if p > offsets[s] else 0 for s, p in zip(c.string, c.place)]
    assert c.lcp.tolist() == common_prefixes(got)
    width = 5
    first = {}
    for s, x in enumerate(strings):
        for i in range(len(x) - width + 1):
            first.setdefault(x[i:i + width], (s, i))
    want = sorted((s, i) for s, x in enumerate(strings) for i in range(len(x) - width + 1)
                  if first[x[i:i + width]] != (s, i))
    string, at = c.repeats(offsets, width, np.arange(len(strings)), np.zeros(len(strings), np.int64))
    assert sorted(zip(string.tolist(), at.tolist())) == want


def test_anchors_do_not_depend_on_the_block():
    rng = np.random.default_rng(5)
    one = rng.integers(97, 101, 3000).astype(np.uint8)
    alone = suffix_dedup.cut_segments(one, np.array([0, len(one)]))
    pad = rng.integers(97, 101, 50_000).astype(np.uint8)
    among = suffix_dedup.cut_segments(np.concatenate((pad, one)), np.array([0, len(pad), len(pad) + len(one)]))
    mine = among[0] == 1
    assert all(np.array_equal(a, b[mine]) for a, b in zip(alone[1:], among[1:]))


def test_marks_of_a_key_with_many_equal_segments():
    rows = np.zeros(1000, anchors.ROW)
    rows["key"], rows["h"], rows["d"], rows["n"] = 5, 9, np.arange(1000), 3
    sent = anchors.local_marks(rows)
    assert np.count_nonzero(sent["kind"] == anchors.REMOVED) == 999
    assert np.count_nonzero(sent["kind"] == anchors.ASK) == 1
    assert len(anchors.global_marks(sent[sent["kind"] <= anchors.TELL])) == 0


def test_settled_rows_spread_whatever_their_ids():
    """Ids that share a factor with the number of buckets, and one id for all rows."""
    import numpy as np

    from raincheck.llm import anchors
    n, buckets = 20_000, 64
    for d in (np.arange(n) * 1000, np.full(n, -(1 << 63)), np.arange(n) * buckets):
        got = np.bincount(anchors.anywhere(d, np.arange(n), buckets), minlength=buckets)
        assert got.min() > n / buckets / 2 and got.max() < 2 * n / buckets
    rows = np.zeros(4000, anchors.ROW)
    rows["key"], rows["h"], rows["d"], rows["n"] = 7, 9, np.repeat([0, 1000], 2000), 1
    rows["start"] = np.tile(np.arange(2000), 2)          # one content many times: all but the first are settled
    assert len(set(anchors._send(rows, 16).column(0).to_pylist())) == 16


def test_numpy_passes_are_small(llm_spark):
    """The arrays of a pass take many times its text, in every Python worker: no pass takes a megabyte of short texts."""
    def segments(data, offsets):
        assert len(data) <= 1 << 18
        return suffix_dedup.cut_segments(data, offsets)

    docs = llm_spark.range(0, 800, 1, 1).selectExpr("id AS doc_id", "repeat(concat('t', id, ' '), 400) AS text")
    assert anchors.marks(anchors.keyed(docs), segments, suffix_dedup.WIDTH).count() > 0


def some_strings(seed, longest, n=60):
    """Strings from a few texts, some with one byte changed."""
    rng = np.random.default_rng(seed)
    texts = [rng.integers(0, 256, 3 * longest).astype(np.uint8) for _ in range(4)]
    out = []
    for _ in range(n):
        x = texts[rng.integers(4)].copy()
        x[rng.integers(len(x))] = 255
        size = rng.integers(longest // 2, longest)
        at = rng.integers(0, len(x) - size)
        out.append(x[at:at + size].tobytes())
    return out


def joined(strings):
    return np.frombuffer(b"".join(strings), np.uint8), np.concatenate(([0], np.cumsum([len(s) for s in strings])))


@pytest.mark.parametrize("width, size", [(100, 4), (10, 2), (7, 1)])
def test_every_window_is_whole_symbols_of_one_column_string(width, size):
    strings = some_strings(width, 2 * width) + [b"x" * width, b"y" * (width - 1), b""]
    symbols, ends, row, front = suffix_dedup.wide_columns(*joined(strings), width, size)
    names, got = {}, []
    for i, r in enumerate(row):
        assert ends[i + 1] - ends[i] <= len(strings[r]) // size       # a size-th of the columns
        for k in range(ends[i + 1] - ends[i]):
            at = front[i] + k * size
            assert names.setdefault(symbols[ends[i] + k], strings[r][at:at + size]) == strings[r][at:at + size]
            if k + width // size <= ends[i + 1] - ends[i]:
                got.append((r, at))
    assert sorted(got) == [(r, p) for r, s in enumerate(strings) for p in range(len(s) - width + 1)]
    assert [names[k] for k in sorted(names)] == sorted(names.values()) and len(set(names.values())) == len(names)


@pytest.mark.parametrize("width", [100, 10, 7])
def test_spans_keep_every_repeat_and_no_string_without_one(width):
    rng = np.random.default_rng(1000 + width)
    alone = [rng.integers(0, 256, width + 30).astype(np.uint8).tobytes() for _ in range(5)]
    strings = some_strings(width, 2 * width) + alone
    strings = [s for s in strings if len(s) >= width]
    row, first, count = suffix_dedup.shared_spans(*joined(strings), width)
    _, offsets = joined(strings)
    held = {(r, p) for r, f, n in zip(row, first - offsets[row], count) for p in range(f, f + n - width + 1)}
    seen = {}
    for r, s in enumerate(strings):
        for p in range(len(s) - width + 1):
            seen.setdefault(s[p:p + width], []).append((r, p))
    assert {x for places in seen.values() if len(places) > 1 for x in places} <= held
    assert max(row) < len(strings) - len(alone) and len(row) == len(set(row.tolist()))
    assert suffix_dedup.shared_spans(*joined(alone), width)[0].tolist() == []


@pytest.mark.parametrize("width", [100, 10, 7])
def test_a_bucket_s_repeats_in_few_columns(width, monkeypatch):
    """Against brute force; strings that share too little never reach the transform, the others
    with a few symbols each."""
    import pyarrow as pa

    rng = np.random.default_rng(width)
    alone = [rng.integers(0, 256, width + 30).astype(np.uint8).tobytes() for _ in range(5)]
    strings = [s for s in some_strings(3 * width, 2 * width) if len(s) >= width] + alone
    d = rng.integers(-3, 9, len(strings))
    start = np.arange(len(strings)) * 1000
    columns = []

    class Seen(suffix_dedup.Collection):
        def __init__(self, data, offsets):
            columns.append((len(offsets) - 1, int(np.diff(offsets).max(initial=0))))
            super().__init__(data, offsets)

    monkeypatch.setattr(suffix_dedup, "Collection", Seen)
    batch = suffix_dedup._batch(np.zeros(len(strings)), d, np.zeros(len(strings)), start,
                                np.array([len(s) - width + 1 for s in strings]), strings)
    got = {(x["d"], p) for out in suffix_dedup._compare(width)(iter([batch])) for x in out.to_pylist()
           for p in range(x["start"], x["start"] + x["n"])}
    first, want = {}, set()
    places = [(int(d[i]), int(start[i]) + p, s[p:p + width]) for i, s in enumerate(strings) for p in range(len(s) - width + 1)]
    for i, p, w in places:
        first[w] = min(first.get(w, (i, p)), (i, p))
    assert got == {(i, p) for i, p, w in places if first[w] != (i, p)} and got
    symbol = {100: 4, 10: 2, 7: 1}[width]
    assert len(columns) == 1 and columns[0][1] <= 2 * width // symbol
    assert columns[0][0] <= symbol * (len(strings) - len(alone))

    # A bucket whose strings share nothing.
    batch = suffix_dedup._batch(np.zeros(5), d[:5], np.zeros(5), start[:5], np.full(5, 31), alone)
    assert list(suffix_dedup._compare(width)(iter([batch]))) == [] and columns[1] == (0, 0)


def test_stretches_by_brute_force():
    """Short, empty and equal texts in one block: every window lies in one stretch, with its leftmost smallest gram."""
    rng = np.random.default_rng(11)
    width, gram = 12, 5
    strings = [rng.integers(0, 3, n).astype(np.uint8).tobytes() for n in (0, 40, 11, 12, 13, 0, 60, 12, 3, 12, 5, 4, 0)]
    data, offsets = joined(strings)
    row, start, n, key, h = suffix_dedup.cut_segments(data, offsets, width, gram)
    rolling = suffix_dedup.C.Rolling(data)
    of = suffix_dedup.C.mix((rolling.sums[gram:] - rolling.sums[:-gram]) * rolling.down[:len(data) - gram + 1])
    least = {}
    for r, s in enumerate(strings):
        for p in range(len(s) - width + 1):
            least[r, p] = min(((int(of[offsets[r] + q]) >> 32), q) for q in range(p, p + width - gram + 1))[1]
    got = {(r, p): int(k) for r, s, m, k in zip(row.tolist(), start.tolist(), n.tolist(), key) for p in range(s, s + m)}
    assert sum(n) == len(got) and got == {x: int(of[offsets[x[0]] + q]) for x, q in least.items()}
    for i in range(1, len(row)):                         # each is as long as it can be
        assert row[i] != row[i - 1] or least[row[i], start[i]] != least[row[i], start[i] - 1]
    same = {}
    for r, s, m, x in zip(row.tolist(), start.tolist(), n.tolist(), h.tolist()):
        text = strings[r][s:s + m - 1 + width]
        assert same.setdefault(text, x) == x
    assert len(set(same.values())) == len(same)


def test_order_of_rows_with_ties():
    rng = np.random.default_rng(12)
    rows = np.zeros(3000, anchors.ROW)
    for column, top in (("key", 900), ("h", 3), ("d", 4), ("start", 5)):
        rows[column] = rng.integers(0, top, len(rows))
    got, by = anchors._order(rows), ["key", "h", "d", "start"]
    assert np.array_equal(got[by], np.sort(rows[by], order=by))
    assert len(anchors._order(rows[:0])) == 0 and len(anchors._order(rows[:1])) == 1


def test_stretches_are_cut_in_small_passes(llm_spark, monkeypatch):
    """Arrays of a pass take eight bytes a byte of text: they are to stay in a core's cache."""
    assert suffix_dedup.PASS_BYTES <= 1 << 16

    def segments(data, offsets):
        assert len(data) <= 1 << 16
        return cut(data, offsets)

    cut = suffix_dedup.cut_segments
    monkeypatch.setattr(suffix_dedup, "cut_segments", segments)
    docs = llm_spark.range(0, 100, 1, 1).selectExpr("id AS doc_id", "repeat(concat('t', id, ' '), 400) AS text")
    assert suffix_dedup.repeated_places(anchors.keyed(docs)).count() > 0
