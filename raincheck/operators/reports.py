"""The four dashboard queries (Q1-Q4), as DataFrames with the panel columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raincheck.functions.numeric import exact_sum
from raincheck.functions.weather import weather_label
from raincheck.operators.joins import join_product, join_weather
from raincheck.operators.windows import share_of_total, top_n_per_group


def revenue_by_weather_over_time(region_mart: DataFrame) -> DataFrame:
    """Q1 (time series): mean of the mart's revenue rows per day and rain
    flag (an unweighted mean over region x size rows); ordered by time."""
    g = region_mart.groupBy("sale_date", "is_rain").agg(F.avg("total_revenue").alias("value"))
    return (g.orderBy(F.col("sale_date").asc_nulls_last())
             .select(F.col("sale_date").alias("time"), F.col("value").cast("double").alias("value"),
                     weather_label("is_rain").alias("metric")))


def product_revenue_by_weather(fact: DataFrame, products: DataFrame, weather: DataFrame) -> DataFrame:
    """Line revenue per (category, sub_category, is_rain) from the base tables."""
    lines = fact.select("product_id", "store_id", "date", "line_total")
    j = join_product(join_weather(lines, weather, cols=("is_rain",)), products)
    return j.groupBy("category", "sub_category", "is_rain").agg(
        exact_sum("line_total").alias("total_revenue"))


def top_products_by_weather(fact: DataFrame, products: DataFrame, weather: DataFrame,
                            n: int = 5, keep_rank: bool = False) -> DataFrame:
    """Q2 (table): the top ``n`` category/sub-category pairs by line revenue
    within each rain flag, ties included; ordered by rain flag, then rank."""
    g = product_revenue_by_weather(fact, products, weather)
    top = top_n_per_group(g, "is_rain", "total_revenue", n)
    return (top.orderBy(F.col("is_rain").asc_nulls_last(), F.col("rank"))
               .select("category", "sub_category",
                       weather_label("is_rain").alias("weather_condition"),
                       F.col("total_revenue").cast("double").alias("total_revenue"), *(["rank"] if keep_rank else [])))


def revenue_by_size_and_temperature(size_mart: DataFrame) -> DataFrame:
    """Q3 (bar chart): revenue per store size and temperature range."""
    g = size_mart.groupBy("store_size", "temperature_range").agg(
        F.sum("total_revenue").alias("total_revenue"))
    return (g.orderBy(F.col("store_size").asc_nulls_last(), F.col("temperature_range").asc_nulls_last())
             .select("store_size", "temperature_range",
                     F.col("total_revenue").cast("double").alias("total_revenue")))


def transactions_by_weather(region_mart: DataFrame, with_share: bool = False) -> DataFrame:
    """Q4 (pie chart): the mart's distinct-invoice counts added per rain flag.

    Grouping is by the flag, the label comes after, so false and NULL are
    two 'Not Rainy' slices. ``with_share`` adds each slice's fraction (W3).
    """
    g = region_mart.groupBy("is_rain").agg(F.sum("transaction_count").alias("total_transactions"))
    out = g.select(weather_label("is_rain").alias("weather_condition"),
                   F.col("total_transactions").cast("bigint").alias("total_transactions"))
    return share_of_total(out, "total_transactions") if with_share else out
