"""HTML extraction: markup, the suffix array over a host's pages, odd rows."""

import random
from collections import defaultdict

import pytest

from raincheck.llm import html_extract as H

SCHEMA = "page_id bigint, url string, html string, row string, packed int, covers string, text string, n_blocks string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, "c", "t", "b") for r in rows], SCHEMA)


def text_of(html):
    page = H.blocks(html)
    return [t for (t, _), k in zip(page, H.keep(page, set()), strict=True) if k]


PAGES = [
    # Menus, header, footer, sidebar, notice, advert, form, script, style, comments around and inside an article.
    ("<html><head><title>No</title><style>p{}</style><script>var t='</p><article>no';</script></head><body>"
     "<header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><div class='cookie-notice'>We use cookies</div>"
     "<main><div>loose</div><article><h1>A &amp; B&nbsp;C</h1><!-- no <p> --><p>One\n two<br>three <b>bo</b>ld"
     "<p>Second<script>no()</script> part<div class='ad'>Buy</div><aside>Side</aside><form>Name<input></form>"
     "<p>Third &lt;p&gt;</p><footer>Meta</footer><section id=comments><h2>Comments</h2><article>me too</article></section>"
     "</article></main><aside><article>teaser</article></aside><footer>&copy;</footer></body></html>",
     ["A & B C", "One two three bold", "Second part", "Third <p>"]),
    # Left open and cut off: an advert and a navigation that the article ends.
    ("<nav><a href='/'>x</a><div class=\"ad\">y<article><h2>Title</h2><p><b>bold.<br><p>more <i>text",
     ["Title", "bold.", "more text"]),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", ["a", "b", "c d", "e"]),
    ("<body class='with-sidebar'><div class='no-ads post-content'>kept</div><div class=sidebar-left>gone</div></body>", ["kept"]),
    ("<article><header><h1>Head</h1></header><div class='entry-header'>by</div><p class='lead'>x</p></article>", ["Head", "by", "x"]),
    ("<article><p title='a > b' data-x=it's>quoted</p><p title=\"unclosed>still</p></article>", ["quoted", "still"]),
    ("no markup, 3 < 4 & 5", ["no markup, 3 < 4 & 5"]),
    ("<script>never closed <p>no", []), ("<!-- never closed <p>no", []), ("", []), ("</p></div></article>", []),
    ("<p>a</p>" * 3, ["a", "a", "a"]), ("<textarea>no</textarea><select><option>no</select><p>yes", ["yes"]),
]


@pytest.mark.parametrize("html,want", PAGES)
def test_markup(html, want):
    assert text_of(html) == want


def site(seed=2, pages=120):
    """Hosts of very different size, menus and notices without names, copies, repeated and odd rows."""
    rng = random.Random(seed)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))

    menus = {h: [prose(1) for _ in range(7)] for h in range(6)}
    notice, shared = {h: prose(12) for h in range(6)}, prose(30)
    rows = []
    for i in range(pages):
        h = 0 if i % 3 else rng.randrange(6)
        body = [prose(rng.randint(1, 40)) for _ in range(rng.randint(0, 4))] + [shared] * (i % 7 == 0)
        named = i % 5 == 0
        html = ("<div>" + "".join(f"<li>{m}" for m in menus[h][: rng.randint(2, 7)]) + "</div>" + f"<p>{notice[h]}"
                + ("<article>" if named else "") + "".join(f"<p>{p}</p>" for p in body) + ("</article>" if named else "")
                + f"<div>{menus[h][0]}</div><div>{menus[h][1]}</div><div>end of {h}</div>")
        rows.append((i, f"https://H{h}.example/{i}?q#f", html))
    copy = "<div><p>" + "<p>".join(prose(9) for _ in range(3)) + "</div>"
    rows += [(900, "http://h0.example/a", copy), (901, "http://h0.example/b", copy), (902, "http://alone.example/", copy)]
    rows += [rows[1]] * 20 + [(None, None, rows[2][2]), (None, None, rows[2][2]), (None, "no host", "<p>x y z a b c d</p>"),
                              (77, None, None), (78, "http://h1.example", ""), (79, "http://h9.example", "<p>" + "long " * 50000)]
    rows += [(80, "http://rep.example/1", "<p>same six words in a row</p>" * 50), (81, "http://rep.example/2", "<p>other</p>")]
    return rows


def expected(rows):
    pages = {r: H.blocks(r[2] or "") for r in set(rows)}
    runs, seen = {}, defaultdict(set)
    for r, page in pages.items():
        symbols = [t if region < H.NAMED else None for t, region in page]
        own = runs[r] = [(i, tuple(symbols[i:i + w])) for w in range(1, H.DEPTH + 1) for i in range(len(symbols) - w + 1)
                         if None not in symbols[i:i + w] and sum(t.count(" ") + 2 for t in symbols[i:i + w]) >= H.LONG]
        for _, run in own:
            seen[H.host_of(r[1]), run].add(r)
    out = {}
    for r, page in pages.items():
        covered = {j for i, run in runs[r] if len(seen[H.host_of(r[1]), run]) > 1 for j in range(i, i + len(run))}
        out[r] = "\n\n".join(t for (t, _), k in zip(page, H.keep(page, covered), strict=True) if k), len(page), len(covered)
    return out


@pytest.mark.parametrize("partitions", [1, 9])
def test_repeats_against_brute_force(llm_spark, partitions):
    rows = site()
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    was = [llm_spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, (partitions, "false"), strict=True):
            llm_spark.conf.set(n, v)
        got = H.extract(frame(llm_spark, rows).repartition(4)).collect()
    finally:
        for n, v in zip(names, was, strict=True):
            llm_spark.conf.set(n, v)
    want = expected(rows)
    by = defaultdict(list)
    for r in rows:
        by[r[:2]].append(want[r])
    have = defaultdict(list)
    for r in got:
        have[r["page_id"], r["url"]].append((r["text"], r["n_blocks"], r["n_repeated"]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in by.items()}
    # Menus and notices that no name gives away are found; a page that is a copy as a whole is kept.
    texts = {r["page_id"]: r["text"] for r in got}
    assert sum(r["n_repeated"] for r in got) > 500
    assert texts[900] == texts[901] == texts[902] != ""


def test_hot_host_is_cut_like_any_stretch(llm_spark):
    """All pages on one host with one menu: the suffixes still spread over the partitions."""
    rows = [(i, "http://one.example/", "<li>a<li>b<li>c<p>a notice of six words here<p>" + f"page {i} " * 5) for i in range(400)]
    order = ["suffix", "row", "block"]
    suffixes = frame(llm_spark, rows).selectExpr("page_id AS row", "url", "html").mapInArrow(H._suffix_rows, H._SUFFIX)
    dealt = suffixes.repartitionByRange(8, *order).selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 0.25 * 400 * 5


def test_given_pages(llm_spark, small_sf):
    """On the given tables the repeats alone find boilerplate; the query keeps every page."""
    pages = llm_spark.read.parquet(f"{small_sf}/pages.parquet")
    got = {r["page_id"]: r for r in H.query(llm_spark, small_sf).collect()}
    assert set(got) == {r["page_id"] for r in pages.collect()} and all(r["n_chars"] == len(r["text"]) for r in got.values())
    bare = pages.selectExpr("page_id", "url", "regexp_replace(html, '</?(article|nav|footer)>| class=\"ad\"', '') AS html")
    assert H.extract(bare).selectExpr("sum(n_repeated)").first()[0] > 0


def test_empty(llm_spark):
    assert H.extract(frame(llm_spark, [])).collect() == []
