"""The dashboard panels and the ad-hoc analysis over a written warehouse.

``run_pipeline`` writes the star schema and the marts under ``root``; these
functions read them back (only the columns each panel needs) and return the
panel frames. Q1, Q3 and Q4 read the marts; Q2 and X1-X3 read the fact,
product and weather tables, as their source queries do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from raincheck.operators import adhoc, marts, reports
from raincheck.sources import csv, tables


def _weather(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(spark, root, "dim_store_weather").drop("run_date")


def panels(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Q1-Q4 keyed by panel name."""
    m1 = tables.read_table(spark, root, marts.M1)
    m3 = tables.read_table(spark, root, marts.M3)
    fact = tables.read_table(spark, root, "fact_transactions")
    products = tables.read_table(spark, root, "dim_products")
    return {
        "revenue_by_weather_over_time": reports.revenue_by_weather_over_time(m1),
        "top_products_by_weather": reports.top_products_by_weather(
            fact, products, _weather(spark, root)),
        "revenue_by_size_and_temperature": reports.revenue_by_size_and_temperature(m3),
        "transactions_by_weather": reports.transactions_by_weather(m1, with_share=True),
    }


def category_analysis(spark: SparkSession, root: str, categories: list[str] | None = None) -> dict[str, DataFrame]:
    """X1-X3 keyed by name; the wide pivot for the given categories, maps of
    all categories without."""
    fact = tables.read_table(spark, root, "fact_transactions")
    products = tables.read_table(spark, root, "dim_products")
    return {
        "category_sales": adhoc.category_sales(fact, products),
        "category_totals": adhoc.category_totals(fact, products),
        **({"category_maps": adhoc.category_maps(fact, products)} if categories is None
           else {"category_pivot": adhoc.category_pivot(fact, products, categories)}),
    }


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Register every written table as a temporary view under its table name,
    so existing SQL over the star schema and marts runs with ``spark.sql``.

    Staging tables that have been loaded are registered too
    (``staging_stores`` ...). Double-quoted identifiers in such SQL need
    ``spark.sql.ansi.doubleQuotedIdentifiers=true``.
    """
    from raincheck import schemas as S

    for name in S.TABLES:
        if name == "dim_store_weather":
            df = _weather(spark, root)
        else:
            df = tables.read_table(spark, root, name)
            if "batch_id" in df.columns:
                df = df.drop("batch_id")
        df.createOrReplaceTempView(name)
    names = list(S.TABLES)
    staging_dir = f"{root.rstrip('/')}/staging"
    for source, name in csv.STAGING_TABLES.items():
        if tables.live(spark, csv.staging_path(staging_dir, source)):
            csv.read_staging(spark, staging_dir, source).createOrReplaceTempView(name)
            names.append(name)
    return names
