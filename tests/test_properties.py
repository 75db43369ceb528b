"""Properties of the marts over the sf0.001 fixture."""

import pytest
from pyspark.sql import functions as F

from raincheck.operators import marts
from raincheck.operators.joins import join_weather
from raincheck.plans.registry import Inputs


@pytest.fixture(scope="module")
def inputs(spark, small_sf):
    return Inputs(spark, small_sf)


def total(df, c):
    return df.agg(F.sum(c)).first()[0]


def test_mart_totals_agree(inputs):
    i = inputs
    m1 = marts.region_impact(i.fact, i.stores, i.weather)
    m2 = marts.product_sensitivity(i.fact, i.products, i.weather)
    m3 = marts.size_impact(i.fact, i.stores, i.weather)
    joined = join_weather(i.fact, i.weather)
    # revenue: M1 and M3 add the same per-line invoice totals
    assert total(m1, "total_revenue") == total(m3, "total_revenue") == total(joined, "invoice_total")
    # quantity and line counts survive the product grouping
    assert total(m2, "total_quantity") == total(joined, "quantity")
    assert total(m2, "transaction_count") == joined.count()


def test_input_order_changes_nothing(inputs):
    i = inputs
    shuffled = i.fact.repartition(7).orderBy(F.rand(seed=3))
    weather = i.weather.repartition(5).orderBy(F.rand(seed=5))
    a = marts.region_impact(i.fact, i.stores, i.weather)
    b = marts.region_impact(shuffled, i.stores, weather)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a = marts.product_sensitivity(i.fact, i.products, i.weather)
    b = marts.product_sensitivity(shuffled, i.products, weather)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_broadcast_and_shuffle_join_agree(spark, inputs):
    i = inputs
    a = marts.size_impact(i.fact, i.stores, i.weather)
    want = sorted(a.collect(), key=str)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        b = marts.size_impact(i.fact, i.stores, i.weather)
        assert sorted(b.collect(), key=str) == want
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_store_day_is_split_and_exact(spark, inputs):
    """One store-day holds about a third of all lines (arriving from many
    input splits). With the weather join shuffled, AQE splits the hot
    partition (skew join) and the mart equals the broadcast-join result."""
    import contextlib
    import io

    i = inputs
    fact = i.fact
    hot = fact.select("store_id", "date").first()
    copies = fact.filter(F.col("line") <= 4).withColumn("store_id", F.lit(hot.store_id)) \
        .withColumn("date", F.lit(hot.date))
    skewed = fact.unionByName(copies)
    expected = marts.size_impact(skewed, i.stores, i.weather, strict=False)
    want = expected.collect()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        m = marts.size_impact(skewed, i.stores, i.weather)
        got = m.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            m.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert sorted(got) == sorted(want)


def test_hot_key_in_batch_is_reduced_map_side(spark):
    """One key holds a third of the batch: the first-row pick is a partial
    aggregate before the shuffle (no window over the group) and stays exact."""
    import contextlib
    import io

    from raincheck.operators import dims
    n = 30_000
    batch = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("int").alias("k"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"),
        (n - F.col("id")).alias("_seq")).repartition(8)
    out = dims.insert_if_absent(batch, None, ["k"], order_by="_seq")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    assert "partial_min" in plan and "Window" not in plan
    got = {r.k: r.v for r in out.collect()}
    assert len(got) == 1 + 2 * n // 3
    # key 0 keeps the row with the smallest _seq among ids divisible by 3
    assert got[0] == f"v{max(i for i in range(0, n, 3))}"
