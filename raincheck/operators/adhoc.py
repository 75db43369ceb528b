"""The ad-hoc category analysis (X1-X3) over fact ⋈ products."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck.functions.numeric import exact_sum, micro_sum
from raincheck.operators.joins import join_product

def category_lines(fact: DataFrame, products: DataFrame, cols) -> DataFrame:
    return join_product(fact.select("product_id", *cols), products, cols=("category",))


def category_sales(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Lines, invoice-total sum and quantity per store, date and category."""
    j = category_lines(fact, products, ["store_id", "date", "invoice_id", "invoice_total", "quantity"])
    return j.groupBy("store_id", "date", "category").agg(
        F.count("invoice_id").alias("transaction_count"),
        F.sum("invoice_total").alias("invoice_total_by_store_date"),
        F.sum("quantity").alias("quantity"))


def category_totals(fact: DataFrame, products: DataFrame) -> DataFrame:
    """X2 (A8): totals of unit price and quantity over the joined lines,
    melted to (index, value) rows. Unit prices are doubles, so their total is
    taken in micro-units to be independent of the summation order."""
    j = category_lines(fact, products, ["unit_price", "quantity"])
    t = j.agg(micro_sum("unit_price").alias("unit_price"),
              F.sum("quantity").cast("double").alias("quantity"))
    return t.unpivot([], ["unit_price", "quantity"], "index", "value")


def column_names(categories: list[str]) -> dict[str, str]:
    """A column name for each category: its letters and digits (of any
    script) in lower case, joined by ``_``; categories that come out alike
    are numbered in the order given."""
    out: dict[str, str] = {}
    taken: set[str] = set()
    for c in categories:
        base = re.sub(r"\W+", "_", c.lower()).strip("_") or "category"
        name, k = base, 1
        while name in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name)
        out[c] = name
    return out


def category_maps(fact: DataFrame, products: DataFrame) -> DataFrame:
    """X3 with any number of categories: per store and date, maps from category
    to quantity and amount. No category is named in the plan, and none passes
    through the driver; a category without sales has no entry."""
    j = category_lines(fact, products, ["store_id", "date", "quantity", "line_total"])
    sold = j.where(F.col("category").isNotNull()).groupBy("store_id", "date", "category").agg(
        F.sum("quantity").alias("quantity"), exact_sum("line_total").alias("amount"))
    entries = sold.groupBy("store_id", "date").agg(F.sort_array(F.collect_list(
        F.struct("category", "quantity", "amount"))).alias("e"))

    def measure(name):
        return F.map_from_entries(F.transform("e", lambda e: F.struct(e["category"], e[name]))).alias(name)

    return entries.select("store_id", "date", measure("quantity"), measure("amount"))


def category_pivot(fact: DataFrame, products: DataFrame, categories: list[str]) -> DataFrame:
    """One quantity and one amount column for each of the given categories,
    per store and date, 0 where a category had no sales. For all categories of
    the data, whatever they are, see ``category_maps``."""
    cats = list(categories)
    j = category_lines(fact, products, ["store_id", "date", "quantity", "line_total"])
    # The position of the category, so that no category text has to serve as a
    # column name inside the plan; 0 or NULL for others, whose days stay.
    place = F.array_position(F.lit(cats), F.col("category")).cast("int") if cats else F.lit(0)
    numbers = list(range(1, len(cats) + 1))
    sold = j.withColumn("_place", place).groupBy("store_id", "date", "_place").agg(
        F.sum("quantity").alias("quantity"), exact_sum("line_total").alias("amount"))
    # One row at most per day and place. Picks of structs are sort-based: a task
    # holds narrow sorted rows, not a hash table with all columns of every day.
    pick = [F.max(F.when(F.col("_place") == k, F.struct("quantity", "amount"))).alias(str(k)) for k in numbers]
    days = sold.groupBy("store_id", "date")
    p = days.agg(*pick) if pick else sold.select("store_id", "date").distinct()
    names = column_names(cats)
    out = [F.col("store_id"), F.col("date")]
    for k, c in zip(numbers, cats):
        for m in ("quantity", "amount"):
            out.append(F.coalesce(F.col(f"`{k}`.{m}"), F.lit(0)).alias(f"{names[c]}_{m}"))
    return p.select(out)
