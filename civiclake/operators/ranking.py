"""First rows of groups and of whole tables, always with a tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """The first `k` rows of each group with their `rank`.

    Spark prunes to k rows per group and task before the shuffle (WindowGroupLimit), so a hot
    group costs k rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `order`, which must be total."""
    return top_per_group(df, key, order, 1).drop("rank")


def top_in_latest(
    df: DataFrame, period: str, keep: Column, order: Sequence[Column], k: int
) -> DataFrame:
    """The first `k` rows of the latest period among rows satisfying `keep`.

    The latest period is that of the whole table, found before the filter.
    """
    last = df.agg(F.max(period)).scalar()
    return df.where((F.col(period) == last) & keep).orderBy(*order).limit(k)
