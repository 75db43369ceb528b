"""Small typed frames for micro fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from raincheck import schemas as S

FACT_DEFAULTS = dict(
    invoice_id="A", line=1, customer_id=1, product_id=1, size="M", color=None, unit_price=10.0,
    quantity=1, date=dt.date(2025, 3, 4), datetime=dt.date(2025, 3, 4), discount=0.0,
    line_total=10.0, store_id=1, employee_id=1, currency="USD", currency_symbol="$", sku=None,
    transaction_type="Sale", payment_method="Cash", invoice_total=Decimal("100"),
)


def fact(spark, rows):
    full = [{**FACT_DEFAULTS, **r} for r in rows]
    cols = [c.name for c in S.FACT_TRANSACTIONS]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in full],
                                 S.struct_of(S.FACT_TRANSACTIONS))


def stores(spark, rows):
    base = dict(country="C", city="X", store_name="S", number_of_employees=5, zip_code="1",
                size="Small", latitude=Decimal("0"), longitude=Decimal("0"))
    cols = [c.name for c in S.DIM_STORES]
    return spark.createDataFrame([tuple({**base, **r}[c] for c in cols) for r in rows],
                                 S.struct_of(S.DIM_STORES))


def products(spark, rows):
    base = {c.name: None for c in S.DIM_PRODUCTS}
    cols = [c.name for c in S.DIM_PRODUCTS]
    return spark.createDataFrame([tuple({**base, **r}[c] for c in cols) for r in rows],
                                 S.struct_of(S.DIM_PRODUCTS))


def weather(spark, rows):
    base = dict(temp_max=Decimal("15.00"), temp_min=Decimal("5.00"), is_rain=False)
    cols = [c.name for c in S.DIM_STORE_WEATHER]
    return spark.createDataFrame([tuple({**base, **r}[c] for c in cols) for r in rows],
                                 S.struct_of(S.DIM_STORE_WEATHER))
