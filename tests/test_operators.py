"""Micro fixtures for joins, marts, windows, dims and weather (FIXTURES.md §3)."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from raincheck.operators import dims, marts, reports, windows
from raincheck.sources import payloads
from tests import helpers as H

D = dt.date(2025, 3, 4)


def test_invoice_counts_distinct_vs_lines_and_per_line_revenue(spark):
    f = H.fact(spark, [dict(invoice_id="A", line=1), dict(invoice_id="A", line=2)])
    s = H.stores(spark, [dict(store_id=1)])
    p = H.products(spark, [dict(product_id=1, category="c", sub_category="s")])
    w = H.weather(spark, [dict(store_id=1, date_id=D)])
    m1 = marts.region_impact(f, s, w).first()
    assert m1["transaction_count"] == 1
    assert m1["total_revenue"] == Decimal("200.00")  # invoice total counted per line
    m2 = marts.product_sensitivity(f, p, w).agg(F.sum("transaction_count")).first()[0]
    assert m2 == 2


def test_sale_without_weather_is_absent(spark):
    f = H.fact(spark, [dict(date=dt.date(2025, 3, 5))])
    s = H.stores(spark, [dict(store_id=1)])
    w = H.weather(spark, [dict(store_id=1, date_id=D)])
    assert marts.region_impact(f, s, w).count() == 0
    assert marts.size_impact(f, s, w).count() == 0


def test_invoice_in_two_stores_counts_twice_in_q4(spark):
    f = H.fact(spark, [dict(store_id=1, line=1), dict(store_id=2, line=2)])
    s = H.stores(spark, [dict(store_id=1, size="Small"), dict(store_id=2, size="Large")])
    w = H.weather(spark, [dict(store_id=1, date_id=D), dict(store_id=2, date_id=D)])
    q4 = reports.transactions_by_weather(marts.region_impact(f, s, w)).collect()
    assert [(r[0], r[1]) for r in q4] == [("Not Rainy", 2)]


def test_rank_nulls_first_and_ties(spark):
    vals = [None, 30, 20, 20, 10, 5, 1]
    df = spark.createDataFrame([(True, v) for v in vals], "k boolean, v int")
    r = windows.rank_over_aggregate(df, "k", "v").orderBy("rank").collect()
    assert [x["rank"] for x in r] == [1, 2, 3, 3, 5, 6, 7]
    assert r[0]["v"] is None
    assert windows.top_n_per_group(df, "k", "v", 5).count() == 5
    ties = spark.createDataFrame([(True, v) for v in [9, 8, 7, 6, 5, 5]], "k boolean, v int")
    assert windows.top_n_per_group(ties, "k", "v", 5).count() == 6


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v bigint")
    got = {r["k"]: r["share"] for r in windows.share_of_total(df, "v").collect()}
    assert got == {"a": 0.25, "b": 0.75}


def test_insert_if_absent_existing_wins_then_first_in_batch(spark):
    existing = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new", 1), (2, "a", 2), (2, "b", 3)], "k int, v string, _seq int")
    added = dims.insert_if_absent(batch, existing, ["k"], order_by="_seq")
    got = sorted((r.k, r.v) for r in existing.unionByName(added).collect())
    assert got == [(1, "old"), (2, "a")]


def test_dim_dates_includes_leap_day(spark):
    b = spark.createDataFrame([(dt.date(2024, 2, 28), dt.date(2024, 3, 1))], "lo date, hi date")
    rows = dims.dim_dates_between(b).orderBy("date_id").collect()
    assert [r.date_id for r in rows] == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert rows[1].month_name == "February" and rows[1].day_name == "Thursday"


def _payload(store, status, days, tmax, tmin, prcp):
    body = json.dumps({"daily": {"time": days, "temperature_2m_max": tmax,
                                 "temperature_2m_min": tmin, "precipitation_sum": prcp}})
    return (store, status, body)


def test_failed_payload_skipped_and_counted(spark):
    rows = [_payload(1, 200, ["2025-03-01"], [12.5], [3.0], [1.2]),
            _payload(2, 500, ["2025-03-01"], [12.5], [3.0], [1.2])]
    df = spark.createDataFrame(rows, "store_id int, status int, body string")
    obs = Observation("w")
    out = payloads.weather_records(payloads.flatten_weather(df, obs)).collect()
    assert [(r.store_id, r.is_rain) for r in out] == [(1, True)]
    assert obs.get["failed_payloads"] == 1


def test_unequal_payload_arrays_fail(spark):
    rows = [_payload(1, 200, ["2025-03-01", "2025-03-02", "2025-03-03"], [1.0, 2.0, 3.0],
                     [0.0, 0.0, 0.0], [0.0, 0.0])]
    df = spark.createDataFrame(rows, "store_id int, status int, body string")
    with pytest.raises(Exception, match="lacks daily values"):
        payloads.flatten_weather(df).collect()


def test_longer_value_array_is_cut_to_time(spark):
    rows = [_payload(1, 200, ["2025-03-01"], [12.5, 99.0], [3.0, 9.0], [0.5, 9.0])]
    df = spark.createDataFrame(rows, "store_id int, status int, body string")
    out = payloads.flatten_weather(df).collect()
    assert [(r.date_id, r.temp_max, r.precipitation) for r in out] == [("2025-03-01", 12.5, 0.5)]


def test_weather_merge_newest_run_wins_older_days_kept(spark):
    old = H.weather(spark, [dict(store_id=1, date_id=D, temp_max=Decimal("1.00")),
                            dict(store_id=1, date_id=dt.date(2025, 3, 3), temp_max=Decimal("2.00"))])
    new = H.weather(spark, [dict(store_id=1, date_id=D, temp_max=Decimal("9.00"))])
    r1 = payloads.merge_weather(None, old, dt.date(2025, 3, 5))
    merged = payloads.merge_weather(r1, new, dt.date(2025, 3, 6)).orderBy("date_id").collect()
    assert [(r.date_id, r.temp_max) for r in merged] == [
        (dt.date(2025, 3, 3), Decimal("2.00")), (D, Decimal("9.00"))]


def test_read_saved_responses(spark):
    import tempfile
    d = tempfile.mkdtemp(prefix="raincheck-pay-")
    for store, days in [(7, ["2025-03-01", "2025-03-02"]), (12, ["2025-03-01"])]:
        body = json.dumps({"latitude": 1.0, "daily": {
            "time": days, "temperature_2m_max": [10.0] * len(days),
            "temperature_2m_min": [1.0] * len(days), "precipitation_sum": [2.0] * len(days)}})
        with open(f"{d}/store_{store}.json", "w") as f:
            f.write(body)
    rows = payloads.flatten_weather(payloads.read_payload_files(spark, d)).collect()
    assert sorted((r.store_id, r.date_id) for r in rows) == [
        (7, "2025-03-01"), (7, "2025-03-02"), (12, "2025-03-01")]


def test_payload_file_without_a_store_id_fails(spark):
    import tempfile
    d = tempfile.mkdtemp(prefix="raincheck-pay-")
    with open(f"{d}/north.json", "w") as f:
        f.write("{}")
    with pytest.raises(Exception, match="north.json"):
        payloads.read_payload_files(spark, d).collect()


def test_payload_file_status_comes_from_its_content(spark):
    import tempfile
    d = tempfile.mkdtemp(prefix="raincheck-pay-")
    for store, body in [(1, '{"error": true, "reason": "limit"}'), (2, "not json"), (3, '{"daily": {"time": []}}')]:
        with open(f"{d}/{store}.json", "w") as f:
            f.write(body)
    got = {r.store_id: r.status for r in payloads.read_payload_files(spark, d).collect()}
    assert got == {1: payloads.FAILED_STATUS, 2: payloads.FAILED_STATUS, 3: payloads.OK_STATUS}


def test_pivot_of_colliding_and_non_latin_categories(spark):
    import tempfile

    from raincheck.operators import adhoc
    names = ["A B", "A-B", "a b", "漢字", "かな", "!!", None]
    products = H.products(spark, [dict(product_id=i, category=c) for i, c in enumerate(names)])
    fact = H.fact(spark, [dict(product_id=i, quantity=i + 1, line_total=float(i)) for i in range(len(names))])
    out = adhoc.category_pivot(fact, products, sorted(c for c in names if c is not None))
    assert len({c.lower() for c in out.columns}) == 2 + 2 * 6
    assert {"漢字_quantity", "かな_amount"} <= set(out.columns)
    path = tempfile.mkdtemp(prefix="raincheck-pivot-") + "/t"
    out.write.parquet(path)
    row = spark.read.parquet(path).first()
    assert sorted(row[c] for c in out.columns if c.endswith("_quantity")) == [1, 2, 3, 4, 5, 6]


def test_weather_of_the_same_day_that_comes_in_wins(spark):
    day = dt.date(2025, 3, 5)
    old = H.weather(spark, [dict(store_id=1, date_id=D, temp_max=Decimal("9.00")), dict(store_id=2, date_id=D)])
    new = H.weather(spark, [dict(store_id=1, date_id=D, temp_max=Decimal("1.00"))])
    held = payloads.merge_weather(None, old, day)
    again = payloads.merge_weather(held, new, day).collect()
    assert {r.store_id: r.temp_max for r in again} == {1: Decimal("1.00"), 2: Decimal("15.00")}
    late = payloads.merge_weather(held, new, dt.date(2025, 3, 1)).collect()
    assert {r.store_id: r.temp_max for r in late} == {1: Decimal("9.00"), 2: Decimal("15.00")}
