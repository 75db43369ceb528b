"""Exact numeric rules against Python's decimal arithmetic (brute force).

Each example is a batch of groups checked in one Spark job.
"""

import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from raincheck.functions.numeric import exact_avg, micro_sum

cents = st.integers(min_value=-99999, max_value=99999)
values = st.lists(st.one_of(st.none(), cents), min_size=1, max_size=12)
groups = st.lists(values, min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(groups)
def test_exact_avg_is_half_up_of_the_true_mean(spark, gs):
    rows = [(g, None if c is None else Decimal(c) / 100) for g, vs in enumerate(gs) for c in vs]
    df = spark.createDataFrame(rows, "g int, t decimal(5,2)")
    got = {r.g: r.a for r in df.groupBy("g").agg(exact_avg("t", "decimal(5,2)").alias("a")).collect()}
    for g, vs in enumerate(gs):
        xs = [Decimal(c) / 100 for c in vs if c is not None]
        want = None if not xs else (sum(xs) / len(xs)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got[g] == want, (vs, got[g], want)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=50))
def test_whole_unit_rounding_is_half_away_from_zero(spark, xs):
    rows = [(i, Decimal(x) / 100) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "i int, v decimal(18,2)")
    got = {r.i: r.r for r in df.select("i", F.col("v").cast("decimal(10,0)").alias("r")).collect()}
    for i, x in enumerate(xs):
        assert got[i] == (Decimal(x) / 100).quantize(Decimal("1"), ROUND_HALF_UP)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(min_value=0.01, max_value=1e5, allow_nan=False), min_size=1, max_size=60))
def test_micro_sum_is_order_free_and_close(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    a = df.agg(micro_sum("x")).first()[0]
    b = df.orderBy(F.col("x").desc()).repartition(3).agg(micro_sum("x")).first()[0]
    assert a == b
    assert math.isclose(a, math.fsum(xs), rel_tol=0, abs_tol=len(xs) * 5e-7 + 1e-9)


def _tier(n):
    return "Large" if n is None else ("Small" if n <= 7 else "Medium" if n < 10 else "Large")


def _range(t):
    return "hot" if t is None else ("cold" if t < 10 else "moderate" if t <= 25 else "hot")


def _rain(p):
    return False if p is None else p > 1.0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 20)),
                          st.one_of(st.none(), st.integers(-2000, 4000)),
                          st.one_of(st.none(), st.integers(0, 30))), min_size=1, max_size=60))
def test_classifications_match_python(spark, rows):
    from raincheck.functions import rain_flag, store_size_tier, temperature_range
    data = [(i, n, None if t is None else Decimal(t) / 100, None if p is None else p / 10)
            for i, (n, t, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, n int, t decimal(5,2), p double")
    out = {r.i: r for r in df.select("i", store_size_tier("n").alias("s"),
                                     temperature_range("t").alias("r"),
                                     rain_flag("p").alias("w")).collect()}
    for i, n, t, p in data:
        assert (out[i].s, out[i].r, out[i].w) == (_tier(n), _range(t), _rain(p))
