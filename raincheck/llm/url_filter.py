"""URL filter: rules first, else a logistic model on hashed character n-grams.

Operator 5 [native]. The features of a url are the character n-grams of
``^host$`` and ``^path$``, hashed into a fixed number of buckets (host and
path hash apart). The weights come from a logistic regression trained on a
small labelled url table; scoring is one SQL expression over the broadcastless
weight vector (a literal array of ``buckets`` doubles), with no Python code.

Defined results: a null url, or one without ``://``, has empty host and path
and is judged by the model on empty parts; equal rows get equal results; an
empty table gives an empty result; extra columns are not read and ``keep``
names those to carry along. With no labelled rows, or one label only, every
weight is zero and the verdict is that label (``allow`` if there is none).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (rule, verdict): host and its subdomains, then the beginning of the path.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
BUCKETS = 1 << 12
SIZES = (3, 4)
#: Most rows of the labelled url table that a model is trained on.
MAX_LABELLED = 8_000


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest fitting rule (ties: the smaller string), else null."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(rule)) if out is None else out.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if out is None else out


def rule_verdict(rule: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def grams(host: Column, path: Column, sizes: Sequence[int] = SIZES) -> Column:
    """Hashed-feature names: ``h`` or ``p`` and the n-gram, repeats included."""
    lists = []
    for tag, part in (("h", host), ("p", path)):
        lists += [_grams_of(F.concat(F.lit("^"), part, F.lit("$")), n, tag) for n in sizes]
    return F.concat(*lists)


def _grams_of(part: Column, n: int, tag: str) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(part) - (n - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(tag), F.substr(part, i, F.lit(n))))


def bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def train(labelled: DataFrame, buckets: int = BUCKETS, sizes: Sequence[int] = SIZES,
          max_labelled: int = MAX_LABELLED, max_iter: int = 40) -> tuple[list[float], float]:
    """Weights and intercept from (url, label) rows, label ``allow`` or ``block``.

    At most ``max_labelled`` rows are used, those of smallest url hash.
    """
    host, path = parts(F.col("url"))
    rows = (labelled.where(F.col("label").isin("allow", "block"))
            .select("url", (F.col("label") == "block").cast("double").alias("label"))
            .orderBy(F.xxhash64("url"), "url").limit(max_labelled))
    rows = rows.select("label", F.transform(
        grams(host, path, sizes), lambda g: bucket(g, buckets).cast("string")).alias("b"))
    # The term-count stage of the ML library, over the fixed list of bucket names.
    terms = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(buckets)], inputCol="b", outputCol="features")
    data = terms.transform(rows).select("label", "features").cache()
    try:
        counts = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}
        if len(counts) < 2:
            return [0.0] * buckets, 1.0 if 1.0 in counts else -1.0
        model = LogisticRegression(maxIter=max_iter, regParam=1e-3, standardization=False).fit(data)
        return [float(w) for w in model.coefficients.toArray()], float(model.intercept)
    finally:
        data.unpersist()


def score(host: Column, path: Column, weights: Sequence[float], intercept: float,
          sizes: Sequence[int] = SIZES) -> Column:
    """Log odds of ``block``: the intercept and the weight of every n-gram."""
    table = F.lit([float(w) for w in weights])
    return F.aggregate(grams(host, path, sizes), F.lit(float(intercept)),
                       lambda acc, g: acc + F.get(table, bucket(g, len(weights))))


def filter_urls(pages: DataFrame, model: tuple[Sequence[float], float],
                rules: Sequence[tuple[str, str]] = RULES, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """host, path, rule, verdict and the model's log odds for every row."""
    host, path = parts(F.col("url"))
    out = pages.select(*keep, host.alias("host"), path.alias("path"))
    out = out.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    out = out.withColumn("log_odds", score(F.col("host"), F.col("path"), *model))
    by_model = F.when(F.col("log_odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return out.withColumn("verdict", F.coalesce(rule_verdict(F.col("rule"), rules), by_model))


def labelled_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """A labelled url table: the urls that a rule decides, with its verdict."""
    host, path = parts(F.col("url"))
    verdict = rule_verdict(rule_of(host, path, rules), rules)
    return pages.select("url", verdict.alias("label")).where(F.col("label").isNotNull()).distinct()


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    model = train(labelled_by_rules(pages))
    return filter_urls(pages, model).select("page_id", "host", "path", "rule", "verdict", "log_odds")
