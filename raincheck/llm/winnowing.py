"""Document fingerprints by winnowing.

Operator 8 [native]. A k-gram is ``CHARS`` consecutive non-space characters
(code points), and one starts at every such character of the text; each is
hashed as a whole (64 bits of the string; SQL has no rolling hash). Of every
``window`` consecutive k-gram hashes the smallest is chosen, the rightmost of
equal ones, and kept once with its position. Any ``window + k - 1`` non-space
characters that two texts share, at whatever offsets, therefore give both a
common hash (``with_char_fingerprint``). Only built-in SQL functions are used.

A chosen hash is one bigint: 32 bits of hash (stored complemented) above 32
bits of position, so that the plain maximum is the smallest hash and, among
equals, the rightmost position.

Defined results: null text: empty; a text with no non-space character has an empty
fingerprint, one with fewer than k a single hash of all it has; a very long
text is hashed in chunks that overlap; two
empty fingerprints have likeness 1, one empty one 0. Documents are ordered by
(id, null first; hash of the text); repeated rows follow one another. Rows of
one id may span runs; rows that share id and text stay in one. An empty
table gives no rows; columns outside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raincheck.llm.common import doc_key, row_key, stored

#: Characters of a k-gram, and k-grams of a window.
CHARS = 16
CHAR_WINDOW = 16
#: k-grams of a text whose strings are in memory at a time.
_CHUNK = 4_096
#: Documents that one ordered run of the next-document step aims at.
RUN_ROWS = 2_000
_RANKS = 256
#: The hash half of a chosen value; the position is in the other half.
_HASH_BITS = -(1 << 32)


def _tagged(g: Column, i: Column) -> Column:
    return g.bitwiseAND(F.lit(_HASH_BITS)).bitwiseOR(i.cast("bigint"))


def _empty() -> Column:
    return F.expr("cast(array() as array<bigint>)")


def _compact(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def _with_values(df: DataFrame, compact: str, out: str, k: int) -> DataFrame:
    """Add ``out``: the tagged hash of the k-gram at every character of ``compact``
    (a text without spaces); of the whole if it has fewer than k.

    A lookahead reads the k-gram at a place and moves on by one character. The
    text is taken in chunks that overlap by k - 1 characters, so the strings
    of one chunk only are in memory, however long the text.
    """
    grams = F.lit(r"(?s)(?=(.{%d}))." % k)
    chunks = F.regexp_extract_all(compact, F.lit(r"(?s)(?=(.{1,%d})).{1,%d}" % (_CHUNK + k - 1, _CHUNK)), F.lit(1))
    n = F.length(compact)
    return df.withColumn(out, F.when(n >= k, F.flatten(F.transform(chunks, lambda part, q: F.transform(
        F.regexp_extract_all(part, grams, F.lit(1)), lambda g, i: _tagged(F.xxhash64(g), i + q * _CHUNK)))))
        .when(n > 0, F.array(_tagged(F.xxhash64(compact), F.lit(0)))).otherwise(_empty()))


def _with_greatest(df: DataFrame, values: str, out: str, window: int) -> DataFrame:
    """Add ``out``: the greatest tagged value of every window of ``values``; of all if they are fewer."""
    # Greatest over 2, 4, 8.. values, then two of these ranges joined to the
    # full width. Past the end a range is cut short; those places go at last.
    have, last, steps = 1, values, []
    while have < window:
        step = min(have, window - have)
        name = f"__w{have}_{out}"
        df = df.withColumn(name, F.zip_with(
            F.col(last), F.slice(F.col(last), step + 1, F.greatest(F.size(last) - step, F.lit(0))),
            lambda x, y: F.greatest(x, y)))
        steps.append(name)
        have, last = have + step, name
    m = F.size(values)
    return df.withColumn(out, F.when(m > window, F.slice(F.col(last), F.lit(1), m - window + 1))
                         .when(m > 0, F.array(F.array_max(values))).otherwise(F.col(values))).drop(*steps)


def with_char_fingerprint(df: DataFrame, text: str, out: str, k: int = CHARS, window: int = CHAR_WINDOW) -> DataFrame:
    """Add ``out``: the chosen hashes with positions, in order of position; a
    k-gram at every non-space character, positions counted in those.

    Each step is a column of its own that the next step uses more than once,
    so the optimizer keeps it evaluated once per row.
    """
    c, v, m = f"__c_{out}", f"__v_{out}", f"__m_{out}"
    df = _with_values(df.withColumn(c, _compact(F.col(text))), c, v, k)
    return _with_greatest(df, v, m, window).withColumn(out, F.array_distinct(m)).drop(c, v, m)


def with_both_fingerprints(df: DataFrame, k: int = CHARS, window: int = CHAR_WINDOW) -> DataFrame:
    """Add ``edited`` (``text`` with its last quarter replaced by the beginning of
    ``next_text``), ``fingerprint`` and ``edited_fingerprint``.

    The k-grams and windows inside the part that stays are worked out once, for both;
    for the edited text only those that reach into the new part come in addition.
    """
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    df = (df.withColumn("__kept", F.substr("text", F.lit(1), n - cut))
          .withColumn("__given", F.substr("next_text", F.lit(1), cut))
          .withColumn("edited", F.concat("__kept", "__given"))
          .withColumn("__c", _compact(F.col("text")))
          .withColumn("__kept", _compact(F.col("__kept")))
          .withColumn("__inside", F.greatest(F.length("__kept") - (k - 1), F.lit(0)))
          .withColumn("__seam", F.concat(F.substr("__kept", F.col("__inside") + 1), _compact(F.col("__given")))))
    df = _with_values(_with_values(df, "__c", "__v", k), "__seam", "__s", k)
    df = _with_greatest(df, "__v", "__m", window)
    inside = F.col("__inside")
    # Windows inside, and the values that the other ones look at.
    df = df.withColumn("__same", F.greatest(inside - (window - 1), F.lit(0)))
    same = F.col("__same")
    df = df.withColumn("__rest", F.when(inside == 0, F.col("__s")).otherwise(F.concat(
        F.slice("__v", same + 1, inside - same),
        F.when(F.length("__seam") < k, _empty()).otherwise(F.transform("__s", lambda x: x + inside)))))
    df = _with_greatest(df, "__rest", "__n", window)
    df = df.withColumn("fingerprint", F.array_distinct("__m")).withColumn(
        "edited_fingerprint", F.array_distinct(F.when(same == 0, F.col("__n")).otherwise(F.concat(
            F.slice("__m", F.lit(1), same), F.when(F.size("__rest") < window, _empty()).otherwise(F.col("__n"))))))
    return df.drop("__kept", "__given", "__c", "__inside", "__seam", "__v", "__s", "__m", "__same", "__rest", "__n")


def hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, 32)))


def positions(fingerprint: Column) -> Column:
    return F.transform(fingerprint, lambda x: x.bitwiseAND(F.lit(4294967295)))


def digest(fingerprint: Column) -> Column:
    return F.sha2(F.array_join(fingerprint.cast("array<string>"), ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two hash sets (``hashes``)."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)) * F.lit(2.0) / total)


def _runs(docs: DataFrame, run_rows: int, d: Column, th: Column) -> Column:
    """A non-decreasing function of (id, text hash) that cuts the documents into runs.

    Up to 256 quantiles of the id, then equal steps between two of them, so a
    run has about ``run_rows`` documents at any size of the table. An id that
    is more than one quantile holds a good part of all rows: its own rows come
    first in their interval, in equal steps of the text hash.
    """
    ranks = [i / _RANKS for i in range(_RANKS + 1)]
    n, q = docs.agg(F.count(F.lit(1)), F.percentile_approx("__d", ranks, 10_000)).first()
    if not n or n <= run_rows:
        return F.lit(0).cast("bigint")
    times = Counter(q)
    bounds = sorted(times)
    hot = {x: max(1, -(-n * c // (_RANKS * run_rows))) for x, c in times.items() if c > 1}
    steps = max(1, -(-n // (max(1, len(bounds) - 1) * run_rows)))
    wide = max([steps, *hot.values()])
    at = F.array_size(F.filter(F.lit(bounds), lambda b: b <= d))
    low, high = F.get(F.lit(bounds), at - 1), F.get(F.lit(bounds), at)
    part = F.when((at == 0) | (at >= len(bounds)), F.lit(0)).otherwise(F.least(F.lit(steps - 1), F.floor(
        (d.cast("double") - low.cast("double")) / (high.cast("double") - low.cast("double")) * steps))) + wide
    if hot:
        own = F.get(F.lit([hot.get(x, 0) for x in bounds]), at - 1)          # its steps, 0 for an id that is not hot
        part = F.when((at > 0) & (low == d) & (own > 0), F.least(own - 1, F.floor(
            (th.cast("double") / 2.0 ** 64 + 0.5) * own))).otherwise(part)
    return at.cast("bigint") * (2 * wide) + part


def with_next(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """doc_id, text, fingerprint, next_text and next_fingerprint of the next
    document in ascending order (after the last: the first), edited, edited_fingerprint.

    The texts are exchanged once, by run, and read from that exchange three
    times: all documents but the last of each run find their next one inside
    the run; the last ones are joined to the first ones of the runs that follow.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Never null, and known to be: a null filter in only some of the branches would part their exchanges.
    run = _runs(rows.select(doc_key().alias("__d")), run_rows, doc_key(), row_key())
    rows = rows.withColumn("__run", F.coalesce(run, F.lit(0).cast("bigint")))
    place = F.struct(doc_key().alias("d"), row_key().alias("th"))
    ends = rows.groupBy("__run").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    order = Window.orderBy("__run")                      # one small row per run
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = stored(ends.withColumn("next_run", F.coalesce(
        F.lead("__run").over(order), F.first("__run").over(whole))), "runs")
    dealt = rows.repartition("__run")

    inside = Window.partitionBy("__run").orderBy("d", "th")
    most = dealt.withColumn("d", doc_key()).withColumn("th", row_key())
    most = with_both_fingerprints(most.withColumn("next_text", F.lead("text").over(inside)))
    most = (most.withColumn("next_fingerprint", F.lead("fingerprint").over(inside))
            .where(F.col("next_text").isNotNull()))

    heads = dealt.join(ends.select("__run", "first"), "__run").where(place == F.col("first")).dropDuplicates(["__run"])
    heads = with_char_fingerprint(heads.select(F.col("__run").alias("next_run"), F.col("text").alias("next_text")),
                             "next_text", "next_fingerprint")
    tails = dealt.join(ends.select("__run", "last", "next_run"), "__run").where(place == F.col("last"))
    tails = with_both_fingerprints(tails.dropDuplicates(["__run"]).drop("last").join(heads, "next_run"))
    names = ["doc_id", "text", "fingerprint", "next_text", "next_fingerprint", "edited", "edited_fingerprint"]
    return most.select(names).unionByName(tails.select(names))


def query(spark, sf_dir: str) -> DataFrame:
    docs = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    docs = (docs.withColumn("n_chars", F.length("text").cast("bigint"))
            .withColumn("__a", hashes(F.col("fingerprint")))
            .withColumn("__b", hashes(F.col("edited_fingerprint")))
            .withColumn("__c", hashes(F.col("next_fingerprint"))))
    return docs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("fingerprint")).alias("fingerprint"),
        digest(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("__a"), F.col("__b")).alias("near_edited"),
        likeness(F.col("__a"), F.col("__c")).alias("near_next"))
