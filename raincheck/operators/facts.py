"""The invoice-line fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raincheck import schemas as S
from raincheck.operators.conform import conform


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def rename_transactions(stg: DataFrame) -> DataFrame:
    """19 staged columns -> 20; ``date`` and ``datetime`` both come from
    "Date" (the second through a timestamp, so a time of day is dropped)."""
    return stg.select(
        _q("Invoice ID").alias("invoice_id"), _q("Line").alias("line"),
        _q("Customer ID").alias("customer_id"), _q("Product ID").alias("product_id"),
        _q("Size").alias("size"), _q("Color").alias("color"),
        _q("Unit Price").alias("unit_price"), _q("Quantity").alias("quantity"),
        _q("Date").cast("date").alias("date"),
        _q("Date").cast("timestamp").cast("date").alias("datetime"),
        _q("Discount").alias("discount"), _q("Line Total").alias("line_total"),
        _q("Store ID").alias("store_id"), _q("Employee ID").alias("employee_id"),
        _q("Currency").alias("currency"), _q("Currency Symbol").alias("currency_symbol"),
        _q("SKU").alias("sku"), _q("Transaction Type").alias("transaction_type"),
        _q("Payment Method").alias("payment_method"), _q("Invoice Total").alias("invoice_total"))


def fact_transactions(stg: DataFrame) -> DataFrame:
    """Every staged line becomes a fact row (J5: nothing conflicts, no
    row-level dedupe; the invoice total is rounded to whole units)."""
    return conform(rename_transactions(stg), S.FACT_TRANSACTIONS, "fact_transactions")
