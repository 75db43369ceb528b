"""Window operators over grouped (small) results: rank, top-n, share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_over_aggregate(grouped: DataFrame, partition_by, order_col: str,
                        rank_col: str = "rank") -> DataFrame:
    """RANK() OVER (PARTITION BY .. ORDER BY order_col DESC), NULL first.

    Ties share a rank and the next rank skips. Meant for an already grouped
    frame, so a window partition holds one row per group, not per input row.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    w = Window.partitionBy(*parts).orderBy(F.col(order_col).desc_nulls_first())
    return grouped.withColumn(rank_col, F.rank().over(w))


def top_n_per_group(grouped: DataFrame, partition_by, order_col: str, n: int,
                    rank_col: str = "rank") -> DataFrame:
    """W2 + P12: rows with rank <= n (ties can give more than n rows). The
    planner turns the rank filter into a per-partition group limit that
    prunes before the window's shuffle."""
    return rank_over_aggregate(grouped, partition_by, order_col, rank_col).filter(F.col(rank_col) <= n)


def share_of_total(grouped: DataFrame, value_col: str, share_col: str = "share") -> DataFrame:
    """Each row's fraction of the column total (a pie chart's percent).

    The total is a window over the whole frame, so this is for small,
    already aggregated frames only.
    """
    total = F.sum(value_col).over(Window.partitionBy())
    return grouped.withColumn(share_col, F.col(value_col).cast("double") / total.cast("double"))
