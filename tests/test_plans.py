"""Plan shape checks: no cartesian products or Python UDFs, no forced join
strategy, no eager jobs, scans pruned."""

import contextlib
import io

import pytest

from raincheck.operators import joins, marts, reports
from raincheck.plans.registry import Inputs


def _explain(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def inputs(spark, small_sf):
    return Inputs(spark, small_sf)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("build", ["m1", "m2", "m3", "q2"])
def test_mart_plans(inputs, build, no_broadcast):
    i = inputs
    df = {
        "m1": lambda: marts.region_impact(i.fact, i.stores, i.weather),
        "m2": lambda: marts.product_sensitivity(i.fact, i.products, i.weather),
        "m3": lambda: marts.size_impact(i.fact, i.stores, i.weather),
        "q2": lambda: reports.top_products_by_weather(i.fact, i.products, i.weather),
    }[build]()
    p = _explain(df)
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert banned not in p
    # the lineitem scan reads only the columns the query needs
    li = [ln for ln in p.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln]
    assert li and all("l_tax" not in ln and "l_partkey" not in ln or build in ("m2", "q2") for ln in li)
    # the fact's lines and the weather's days: lineitem is scanned at most twice
    assert sum("lineitem" in ln and "Location" in ln for ln in p.splitlines()) <= 2


def test_no_join_strategy_is_forced(inputs):
    """Without hints the planner broadcasts the small written dimension."""
    p = marts.size_impact(inputs.fact, inputs.stores, inputs.weather)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in p
    assert p.count("strategy=") <= 1          # the fixture's lineitem x orders


def test_invoice_days_need_no_second_exchange(inputs, no_broadcast):
    """After fact x weather on (store_id, date) the lines are reduced to
    invoice days in the same tasks: no exchange between join and aggregate."""
    i = inputs
    lines = joins.join_weather(i.fact.select("invoice_id", "store_id", "date", "invoice_total"), i.weather)
    p = _explain(marts.invoice_days(lines), mode="simple").splitlines()
    top = next(k for k, ln in enumerate(p) if "SortMergeJoin" in ln and "date" in ln.split("]")[0])
    above = p[:top]
    assert any("HashAggregate" in ln for ln in above) and not any("Exchange" in ln for ln in above)


# Queries whose result is read back from tables that the query itself writes.
WRITES = {"csv_roundtrip", "load_audit", "truncate_staging", "weather_file", "batch_run", "batch_marts", "merge_weather",
          "catalog_tables"}


def test_building_a_query_starts_no_job(spark, small_sf):
    from raincheck.plans.registry import QUERIES
    names = sorted(set(QUERIES) - WRITES)
    sc = spark.sparkContext
    for name in names:
        QUERIES[name](spark, small_sf)        # the tables' schemas are read once per process
    for name in names:
        sc.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, small_sf)
        jobs = list(sc.statusTracker().getJobIdsForGroup(f"build-{name}"))
        assert jobs == [], name
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_insert_matches_the_existing_table_in_one_anti_join(spark, small_sf):
    from raincheck.operators import dims
    from raincheck.plans.fixture import RetailFixture
    stg = RetailFixture(spark, small_sf).staging_customers
    existing = dims.dim_customers(stg)
    p = _explain(dims.dim_customers(stg, existing), mode="simple")
    assert sum("LeftAnti" in ln for ln in p.splitlines()) == 1 and "LeftSemi" not in p


def test_distinct_count_spreads_a_hot_group_by_invoice(inputs, no_broadcast):
    """The first exchange of M1's exact distinct count hashes on the group
    keys plus invoice_id, so one group with a third of the lines still
    spreads over all reducers."""
    p = _explain(marts.region_impact(inputs.fact, inputs.stores, inputs.weather), mode="simple")
    exch = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln and "invoice_id" in ln]
    assert exch and "country" in exch[0] and "is_rain" in exch[0]


def test_one_hash_table_of_lines_in_the_tasks_of_the_weather_join(inputs, no_broadcast):
    """M1 and M3 reduce the lines once before the exchange of the distinct
    count: a task holds one hash table of them, not one of invoice days too."""
    i = inputs
    for mart in (marts.region_impact, marts.size_impact):
        p = _explain(mart(i.fact, i.stores, i.weather), mode="simple").splitlines()
        weather = next(k for k, ln in enumerate(p) if "SortMergeJoin" in ln and "date" in ln.split("]")[0])
        assert sum("HashAggregate" in ln and "invoice_id" in ln for ln in p[:weather]) == 4   # two by invoice, two that count


def test_wide_pivot_holds_no_hash_table_of_all_columns(inputs, no_broadcast):
    """The days' columns are picked by sorted rows; the hash tables have
    one quantity and one amount."""
    from raincheck.operators import adhoc
    p = _explain(adhoc.category_pivot(inputs.fact, inputs.products, ["ECONOMY", "LARGE", "PROMO"]), mode="simple")
    assert "pivotfirst" not in p and "SortAggregate" in p.split("HashAggregate")[0]
