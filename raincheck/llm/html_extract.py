r"""Main text of web pages by a suffix array over the pages of each host.

Operator 12. A page is read into blocks of text, in page order. What a site
repeats on its pages is boilerplate: the token streams of a host's pages are
put together, long substrings that occur on distinct pages are found in their
suffix array, blocks covered by one are removed, and unique runs are kept.

*Suffix array over Spark's sort.* A suffix is taken at the start of each block;
its symbols are whole blocks (48 bits of hash and the number of tokens: the
words and the block's own mark), three of them, after 48 bits of the host. The
suffixes of all pages are range-partitioned by (suffix, page) and sorted within
partitions, so a partition is a stretch of the array, and a host, or a menu that
a third of all pages carry, is cut like any other stretch. Each suffix is
compared with the nearest one above and below that belongs to another page; a
common prefix of ``LONG`` tokens or more covers its blocks. The first and last
pages of each partition have neighbours elsewhere: those few rows a partition
are sorted once more in one task and compared in the same way.

*Exact check.* Repetition alone is wrong for mirrored articles and passages that
many documents share, and blind on a host with one page, so the markup is
checked too: blocks inside a navigation, header, footer, aside, form, advert,
notice, script or comment element go although nothing repeats them; blocks in an
``article`` (or else ``main`` or an element named as the body of one) are the
text, take no part in the search for boilerplate, and rule out the rest of the
page. On a page whose markup names no article the array decides, unless it
covers all of the page's blocks: then the page as a whole is a copy, and is kept.

Defined results: null or empty html: empty text; null url: empty host; a row is
a page of its own, whatever its page_id (null or repeated), but equal rows count
as one page and get equal results; pages may be of any length and are read
whole; unclosed, misnested or cut markup is read to the end of the page; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck.llm.common import by_key, stored, table

#: Symbols of a suffix, and tokens from which a repeated substring is long.
DEPTH, LONG = 3, 6
HASH = 6
SYMBOL = HASH + 1
WIDTH = HASH + DEPTH * SYMBOL

#: What the markup says of a block.
BOILERPLATE, OPEN, NAMED, ARTICLE = range(4)

# Fixed values of HTML: elements that hold raw text, have no content, or begin a new block.
RAW = set("script style textarea title iframe noembed noframes xmp".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section
summary table tbody tfoot thead tr ul""".split())
GAP = {"br", "td", "th"}
#: Elements that end an open one of the same kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
NOT_TEXT = set("""nav footer aside form menu search dialog noscript template button select datalist svg object audio
video canvas""".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words of class and id names, as sites use them.
NOT_TEXT_WORDS = set("""menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars footer footers ad ads
advert adverts advertisement advertisements advertising sponsor sponsored promo banner cookie cookies consent gdpr notice
notices alert popup modal newsletter subscribe subscription form search login signup share sharing social related
recommended recommendations trending pagination pager toolbar widget widgets skip copyright""".split())
COMMENT_WORDS = set("comment comments reply replies disqus discussion respond".split())
HEADER_WORDS = set("header masthead topbar".split())
TEXT_WORDS = set("article post entry story main".split())
BODY_WORDS = set("body content text".split())
FLAGS = set("no has with without".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')|=)*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@lru_cache(1 << 14)
def named(attributes: str) -> tuple[frozenset[str], str, bool]:
    """Words of class and id, role, and whether the element is an article's body."""
    words, role, body = [], "", False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value, name = "".join(values), name.lower()
        if name == "role":
            role = value.strip().lower()
        elif name == "itemprop":
            body = body or "articlebody" in value.lower()
        else:
            for item in value.split():
                parts = [w.lower() for w in _WORD.findall(item)]
                words += [] if FLAGS & set(parts) else parts
    return frozenset(words), role, body


def says(name: str, attributes: str, region: int, zone: str) -> tuple[int, str]:
    """Region and kind of boilerplate inside an element that opens in these."""
    words, role, body = named(attributes) if "=" in attributes else (frozenset(), "", False)
    if words & COMMENT_WORDS and name not in ("html", "body", "main"):
        return BOILERPLATE, "comment"
    if name in ("article", "main") or role in ("main", "article"):
        # An article in a menu or notice left open ends it; one in an aside, a footer or a comment belongs to it.
        if region == BOILERPLATE and zone in ("aside", "footer", "comment"):
            return region, zone
        return (ARTICLE if "article" in (name, role) else max(region, NAMED)), ""
    if region == BOILERPLATE or name in ("html", "body"):
        return region, zone
    if name in NOT_TEXT or role in ROLES:
        return BOILERPLATE, name if name in ("aside", "footer") else "other"
    headed = name == "header" or (words & HEADER_WORDS and not words & TEXT_WORDS)
    if words & NOT_TEXT_WORDS or (headed and region != ARTICLE):
        return BOILERPLATE, "other"
    if body or "articlebody" in words or (words & TEXT_WORDS and words & BODY_WORDS):
        return max(region, NAMED), zone
    return region, zone


def blocks(html: str) -> list[tuple[str, int]]:
    """The blocks of a page, in order: (text, region)."""
    out: list[tuple[str, int]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int, str]] = []      # open elements with the state outside them
    opened: dict[str, int] = {}
    region, zone, at, end = OPEN, "", 0, len(html)

    def flush():
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((text, region))
            pieces.clear()

    def leave(depth: int):
        nonlocal region, zone
        for name, _, _ in stack[depth:]:
            opened[name] -= 1
        if stack[depth][1] != region:
            flush()
        _, region, zone = stack[depth]
        del stack[depth:]

    while at < end:
        m = _MARKUP.search(html, at)
        upto = m.start() if m else end
        if upto > at:
            text = html[at:upto]
            pieces.append(unescape(text) if "&" in text else text)
        if m is None:
            break
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        elif name in GAP:
            pieces.append(" ")
        if m[1]:
            if opened.get(name):
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                leave(depth)
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if name in VOID:
            continue
        ends = CLOSES.get(name)
        if ends and stack and stack[-1][0] in ends:
            leave(len(stack) - 1)
        elif name in BLOCK and opened.get("p"):
            depth = len(stack) - 1
            while stack[depth][0] != "p":
                depth -= 1
            if not any(s[0] in BLOCK and s[0] != "p" for s in stack[depth:]):
                leave(depth)
        new, kind = says(name, m[3], region, zone)
        if new != region:
            flush()
        stack.append((name, region, zone))
        opened[name] = opened.get(name, 0) + 1
        region, zone = new, kind
    flush()
    return out


def host_of(url: str | None) -> str:
    return re.split(r"[/?#]", url.split("://", 1)[1], maxsplit=1)[0].lower() if url and "://" in url else ""


def _hash(text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=HASH).digest()


def suffixes(page: list[tuple[str, int]], host: bytes) -> list[tuple[int, bytes]]:
    """(block, suffix) for each block that is not named as text. A suffix that
    the page repeats stands once; a stretch of text ends the ones before it."""
    symbols = [_hash(text) + bytes([min(255, text.count(" ") + 2)]) if region < NAMED else None for text, region in page]
    out: dict[bytes, int] = {}
    for i, symbol in enumerate(symbols):
        if symbol is not None:
            key = host
            for s in symbols[i:i + DEPTH]:
                if s is None:
                    break
                key += s
            out.setdefault(key.ljust(WIDTH, b"\0"), i)
    return [(i, key) for key, i in out.items()]


def keep(page: list[tuple[str, int]], covered: set[int]) -> list[bool]:
    """Which blocks of a page are its main text."""
    best = max((region for _, region in page), default=OPEN)
    if best >= NAMED:
        return [region == best for _, region in page]
    unique = [region == OPEN and i not in covered for i, (_, region) in enumerate(page)]
    return unique if any(unique) else [region == OPEN for _, region in page]


# --- Spark ------------------------------------------------------------------

_SUFFIX = "suffix binary, row bigint, block int"
_FOUND = "edge boolean, suffix binary, row bigint, block int, blocks int"


def _suffix_rows(batches):
    for batch in batches:
        out = ([], [], [])
        for row, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if html:
                host = _hash(host_of(url))
                for i, key in suffixes(blocks(html), host):
                    out[0].append(key)
                    out[1].append(row)
                    out[2].append(i)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.int32())], ["suffix", "row", "block"])


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Blocks in the common prefix of suffixes, row by row, where it is long."""
    same = (a[:, :HASH] == b[:, :HASH]).all(axis=1)
    tokens, n = np.zeros(len(a), np.int64), np.zeros(len(a), np.int32)
    for k in range(DEPTH):
        at = slice(HASH + k * SYMBOL, HASH + (k + 1) * SYMBOL)
        count = a[:, at][:, -1].astype(np.int64)
        same = same & (count > 0) & (a[:, at] == b[:, at]).all(axis=1)
        tokens += np.where(same, count, 0)
        n += same
    return np.where(tokens >= LONG, n, 0)


def neighbours(rows: pa.Table) -> pa.RecordBatch:
    """Sorted suffixes in; those that a neighbour of another page covers out,
    and the first and last rows, whose neighbours may be in other partitions."""
    n = rows.num_rows
    suffix = rows.column("suffix").combine_chunks()
    row, block = (rows.column(c).to_numpy() for c in ("row", "block"))
    data = np.frombuffer(suffix.buffers()[2], np.uint8)
    keys = data[suffix.offset * WIDTH:][:n * WIDTH].reshape(n, WIDTH)
    new = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))     # stretches of one page
    of = np.cumsum(np.concatenate(([0], (row[1:] != row[:-1]).astype(np.int64))))
    above, below = new[of] - 1, np.append(new[1:], n)[of]
    covers = np.zeros(n, np.int32)
    for other, there in ((above, above >= 0), (below, below < n)):
        covers[there] = np.maximum(covers[there], common(keys[there], keys[other[there]]))
    # The first and last page, and the row next to each.
    edge = (above < 0) | (below >= n)
    edge[np.minimum(below[0], n - 1)] = edge[max(above[-1], 0)] = True
    found = np.flatnonzero((covers > 0) | edge)
    taken = pa.array(found)
    return pa.RecordBatch.from_arrays(
        [pa.array(edge[found]), pc.if_else(pa.array(edge[found]), suffix.take(taken), None), pa.array(row[found]), pa.array(block[found].astype(np.int32)),
         pa.array(covers[found])], ["edge", "suffix", "row", "block", "blocks"])


def _neighbour_rows(batches):
    kept = [b for b in batches if b.num_rows]
    if kept:
        yield neighbours(pa.Table.from_batches(kept))


def repeated(pages: DataFrame) -> DataFrame:
    """Blocks that the host's other pages repeat: row, and (block, number of
    blocks from there on) pairs. ``pages``: row, url, html."""
    order = ["suffix", "row", "block"]
    rows = pages.select("row", "url", "html").mapInArrow(_suffix_rows, _SUFFIX).distinct()
    found = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbour_rows, _FOUND),
                   "html-repeats")
    # A few rows of each partition, once more together: one task, whose size does not depend on the pages' number.
    outer = found.where("edge").select(*order).repartition(1).sortWithinPartitions(*order).mapInArrow(_neighbour_rows, _FOUND)
    covers = found.unionByName(outer).where("blocks > 0")
    return covers.groupBy("row").agg(F.collect_set(F.struct("block", "blocks")).alias("covers"))


def _read(batches):
    """Blocks of each page, packed: half the bytes of what is exchanged."""
    for batch in batches:
        html = batch.column("html").to_pylist()
        packed = [zlib.compress(json.dumps(blocks(h) if h else [], ensure_ascii=False).encode("utf-8", "surrogatepass"), 1)
                  for h in html]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url", "row")), pa.array(packed, pa.binary())],
            ["page_id", "url", "row", "packed"])


def _decide(batches):
    for batch in batches:
        texts, counts = [], []
        for packed, covers in zip(batch.column("packed").to_pylist(), batch.column("covers").to_pylist(), strict=True):
            page = json.loads(zlib.decompress(packed).decode("utf-8", "surrogatepass"))
            symbols = [text if region < NAMED else None for text, region in page]
            # A suffix that the page repeats was sent once: its covers hold wherever it stands.
            first = {tuple(symbols[c["block"]:c["block"] + c["blocks"]]) for c in covers or []}
            widths = {len(f) for f in first}
            covered = {j for w in widths for i in range(len(symbols) - w + 1)
                       if symbols[i] is not None and tuple(symbols[i:i + w]) in first for j in range(i, i + w)}
            kept = keep(page, covered)
            texts.append("\n\n".join(text for (text, _), k in zip(page, kept, strict=True) if k))
            counts.append((len(page), len(covered)))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url")), pa.array(texts, pa.string()),
             *(pa.array([c[k] for c in counts], pa.int64()) for k in (0, 1))],
            ["page_id", "url", "text", "n_blocks", "n_repeated"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, main text, blocks read, and blocks that the host repeats."""
    keyed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
                         F.xxhash64("page_id", "url", "html").alias("row"))
    read = keyed.mapInArrow(_read, "page_id bigint, url string, row bigint, packed binary")
    joined = by_key(read, repeated(keyed), ["row"], "left").select("page_id", "url", "packed", "covers")
    return joined.mapInArrow(_decide, "page_id bigint, url string, text string, n_blocks bigint, n_repeated bigint")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


# These pages name their article and nest nothing in it but paragraphs and
# headings, so patterns can read them.
ORACLE = r"""
WITH bodies AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)(?:</article>|$)', 1) AS body FROM pages
), pieces AS (
  SELECT page_id, url, list_transform(
    string_split_regex(regexp_replace(regexp_replace(body, '<br[^>]*>', ' ', 'g'), '</?(b|i|em|strong|a|span|u)( [^>]*)?>', '', 'g'), '<[^>]*>'),
    lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x,
      '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#(x27|39);?', '''', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS said
  FROM bodies
), texts AS (
  SELECT page_id, url, array_to_string(list_filter(said, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM pieces
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts
"""
