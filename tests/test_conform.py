"""Assignment rules: casts, lengths, not-null, overflow."""

import datetime as dt
from decimal import Decimal

import pytest

from raincheck import schemas as S
from raincheck.operators.conform import conform
from raincheck.operators.facts import fact_transactions
from raincheck.operators.marts import region_impact
from tests import helpers as H

TX_ROW = {
    "Invoice ID": "A", "Line": "1", "Customer ID": "1", "Product ID": "1", "Size": "M",
    "Color": None, "Unit Price": "1.5", "Quantity": "2", "Date": "2025-03-04 17:30:00",
    "Discount": "0.0", "Line Total": "3.0", "Store ID": "1", "Employee ID": "1",
    "Currency": "USD", "Currency Symbol": "$", "SKU": "x", "Transaction Type": "Sale",
    "Payment Method": "Cash", "Invoice Total": "2.5",
}


def staged(spark, **over):
    row = {**TX_ROW, **over}
    return spark.createDataFrame([tuple(row[h] for h in S.CSV_HEADERS["transactions"])],
                                 S.all_string_schema(S.CSV_HEADERS["transactions"]))


def test_date_and_datetime_lose_time_of_day(spark):
    r = fact_transactions(staged(spark)).first()
    assert r["date"] == dt.date(2025, 3, 4) and r["datetime"] == dt.date(2025, 3, 4)
    assert r["invoice_total"] == Decimal("3")
    assert r["quantity"] == 2 and r["unit_price"] == 1.5


def test_float_spelled_integer_is_accepted(spark):
    assert fact_transactions(staged(spark, Quantity="7.0")).first()["quantity"] == 7


def test_bad_date_fails(spark):
    with pytest.raises(Exception):
        fact_transactions(staged(spark, Date="not-a-date")).collect()


def test_varchar_overflow_fails(spark):
    with pytest.raises(Exception, match="too long"):
        fact_transactions(staged(spark, Size="XXXXXL")).collect()


def test_null_primary_key_fails(spark):
    df = spark.createDataFrame([(None,)], "customer_id int")
    with pytest.raises(Exception, match="not-null"):
        conform(df, [S.Col("customer_id", "int", None, True)], "dim_customers").collect()


def test_mart_money_wide_by_default_strict_overflows(spark):
    # One cell summing to 10,000,000,000.00 (ten lines of 1e9).
    f = H.fact(spark, [dict(line=i, invoice_total=Decimal("1000000000")) for i in range(10)])
    s = H.stores(spark, [dict(store_id=1)])
    w = H.weather(spark, [dict(store_id=1, date_id=dt.date(2025, 3, 4))])
    assert region_impact(f, s, w).first()["total_revenue"] == Decimal("10000000000.00")
    with pytest.raises(Exception):
        region_impact(f, s, w, strict=True).collect()
