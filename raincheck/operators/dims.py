"""Dimension tables: rename staging columns, derive, conform, insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raincheck import schemas as S
from raincheck.functions.dates import date_parts
from raincheck.functions.weather import store_size_tier
from raincheck.operators.conform import conform

# Optional input-order column of a staging frame (first row per key wins).
SEQ = "_seq"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _project(stg: DataFrame, cols: list[Column]) -> DataFrame:
    """Select ``cols`` and carry the input-order column along when present."""
    return stg.select(*cols, *([F.col(SEQ)] if SEQ in stg.columns else []))


# ------------------------------------------------------------------ P1-P5
def rename_customers(stg: DataFrame) -> DataFrame:
    """9 columns; the birth date is cast to DATE."""
    return _project(stg, [
        _q("Customer ID").alias("customer_id"), _q("Name").alias("name"),
        _q("Email").alias("email"), _q("Telephone").alias("telephone"),
        _q("City").alias("city"), _q("Country").alias("country"),
        _q("Gender").alias("gender"), _q("Date Of Birth").cast("date").alias("date_of_birth"),
        _q("Job Title").alias("job_title")])


def rename_discounts(stg: DataFrame) -> DataFrame:
    """start/end cast to DATE; the rate keeps the source's column spelling."""
    return _project(stg, [
        _q("Start").cast("date").alias("start_date_id"), _q("End").cast("date").alias("end_date_id"),
        _q("Discont").alias("discount_rate"), _q("Description").alias("description"),
        _q("Category").alias("category"), _q("Sub Category").alias("sub_category")])


def rename_employees(stg: DataFrame) -> DataFrame:
    """P3."""
    return _project(stg, [
        _q("Employee ID").alias("employee_id"), _q("Store ID").alias("store_id"),
        _q("Name").alias("name"), _q("Position").alias("position")])


def rename_products(stg: DataFrame) -> DataFrame:
    """12 columns, six description languages."""
    langs = ["PT", "DE", "FR", "ES", "EN", "ZH"]
    return _project(stg, [
        _q("Product ID").alias("product_id"), _q("Category").alias("category"),
        _q("Sub Category").alias("sub_category"),
        *[_q(f"Description {x}").alias(f"description_{x.lower()}") for x in langs],
        _q("Color").alias("color"), _q("Sizes").alias("sizes"),
        _q("Production Cost").alias("production_cost")])


def stores_with_size(stg: DataFrame) -> DataFrame:
    """P5: 8 columns plus the size tier from the employee count (NULL -> Large)."""
    n = _q("Number of Employees").cast("int")
    return _project(stg, [
        _q("Store ID").alias("store_id"), _q("Country").alias("country"), _q("City").alias("city"),
        _q("Store Name").alias("store_name"), n.alias("number_of_employees"),
        _q("ZIP Code").alias("zip_code"), store_size_tier(n).alias("size"),
        _q("Latitude").alias("latitude"), _q("Longitude").alias("longitude")])


# ------------------------------------------------------------------ J4
def insert_if_absent(incoming: DataFrame, existing: DataFrame | None, keys: list[str],
                     order_by: str | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``.

    Existing rows win; within the batch the first row per key (lowest
    ``order_by``) wins, and ``order_by`` is dropped from the result. The
    per-key pick is an aggregate (``min`` of a struct led by the order
    column), so a key holding a large share of the batch is reduced map-side
    before the shuffle, never gathered in one task. Without ``order_by`` the
    smallest full row wins, which is deterministic.

    The match is one anti-join; the planner and adaptive execution choose how
    it runs from the sizes they measure.
    """
    cols = [c for c in incoming.columns if c not in keys and c != order_by]
    out_cols = [c for c in incoming.columns if c != order_by]
    if cols:
        lead = [order_by] if order_by else []
        picked = incoming.groupBy(*keys).agg(F.min(F.struct(*lead, *cols)).alias("_row"))
        first = picked.select(*[F.col(f"_row.{c}").alias(c) if c in cols else F.col(c)
                                for c in out_cols])
    else:
        first = incoming.select(*keys).distinct()
    if existing is None:
        return first
    return first.join(existing.select(*keys), keys, "left_anti")


# ------------------------------------------------------------------ A1, D1
def min_max_date(staging_transactions: DataFrame) -> DataFrame:
    """A1: MIN/MAX of the staged date text (text order, as staged)."""
    return staging_transactions.agg(F.min(_q("Date")).alias("lo"), F.max(_q("Date")).alias("hi"))


def dim_dates_between(bounds: DataFrame) -> DataFrame:
    """Every day in [lo, hi] of a one-row frame, with its calendar parts.

    The row count is the day span, bounded by the calendar, not by the data.
    """
    d = F.col("date_id")
    days = bounds.select(F.explode(F.sequence(
        F.col("lo").cast("date"), F.col("hi").cast("date"), F.expr("interval 1 day"))).alias("date_id"))
    return conform(days.select(d, *date_parts(d)), S.DIM_DATES, "dim_dates")


def dim_dates(staging_transactions: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Date dimension over the staged date range, insert-if-absent."""
    b = min_max_date(staging_transactions).select(
        F.to_date(F.col("lo").cast("timestamp")).alias("lo"),
        F.to_date(F.col("hi").cast("timestamp")).alias("hi"))
    return insert_if_absent(dim_dates_between(b), existing, ["date_id"])


# ------------------------------------------------------------------ D2-D6
def _keyed(renamed: DataFrame, table: str, existing: DataFrame | None) -> DataFrame:
    seq = SEQ if SEQ in renamed.columns else None
    conformed = conform(renamed, S.TABLES[table], table, keep=[seq] if seq else [])
    return insert_if_absent(conformed, existing, S.PRIMARY_KEYS[table], order_by=seq)


def dim_customers(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D2."""
    return _keyed(rename_customers(stg), "dim_customers", existing)


def dim_employees(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D4."""
    return _keyed(rename_employees(stg), "dim_employees", existing)


def dim_products(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D5."""
    return _keyed(rename_products(stg), "dim_products", existing)


def dim_stores(stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """D6."""
    return _keyed(stores_with_size(stg), "dim_stores", existing)


def dim_discounts(stg: DataFrame) -> DataFrame:
    """D3: no key, every staged row is appended."""
    return conform(rename_discounts(stg), S.DIM_DISCOUNTS, "dim_discounts")
