"""Rates, shares and disclosure control."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def multi_reason_share(
    df: DataFrame, by: Sequence[str], reasons: Sequence[str], total: str = "total"
) -> DataFrame:
    """How often each reason is cited and its share of the rows in the group.

    A row may cite one reason in several columns and counts once for it; rows citing several
    reasons count for each, so shares may add up to more than one. One aggregation: every row
    also emits the NULL reason, which carries the group total.
    """
    cited = [F.col(c) for c in reasons]
    first_mention = [
        reduce(lambda a, b: a & b, [~cited[j].eqNullSafe(c) for j in range(i)], c.isNotNull())
        for i, c in enumerate(cited)
    ]
    once = [F.when(test, c) for test, c in zip(first_mention, cited)]
    exploded = df.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("_is_total"), F.lit(None).cast(df.schema[reasons[0]].dataType).alias("reason")),
                *[F.struct(F.lit(False).alias("_is_total"), c.alias("reason")) for c in once],
            )
        ),
    ).where(F.col("_is_total") | F.col("reason").isNotNull())
    counts = exploded.groupBy(*by, "_is_total", "reason").agg(F.count("*").alias("citations"))
    whole = Window.partitionBy(*by)
    return (
        counts.withColumn(total, F.max(F.when(F.col("_is_total"), F.col("citations"))).over(whole))
        .where(~F.col("_is_total"))
        .select(*by, "reason", "citations", total, rate(F.col("citations"), F.col(total)).alias("share"))
    )


def suppress_small(df: DataFrame, n: str, minimum: int, where: Column | None = None) -> DataFrame:
    """Drop cells below the publication minimum; with `where`, only among those rows."""
    enough = F.col(n) >= minimum
    return df.where(enough if where is None else (~where | enough))
