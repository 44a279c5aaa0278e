"""Observed against expected events with the profile held constant (indirect standardisation)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def observed_expected(
    df: DataFrame,
    event: str,
    groups: Mapping[str, str],
    cell: Sequence[str],
    time: Sequence[str] = (),
    min_cell: int = 30,
    min_group: int = 1000,
    unpublished: Sequence[str] = (),
    zone: float = 0.02,
) -> DataFrame:
    """Per time, dimension and group: observed and expected events, ratio and rates.

    `event` is 0/1, `groups` maps a dimension name to its column, `cell` lists the profile
    columns. Expected = over the cells, rows of the group in the cell x event rate of
    everybody in the cell. Only rows with a complete profile in a cell of at least `min_cell`
    rows are comparable; the raw rate and the population use all rows.

    The rows are aggregated once, to (time, cell, group values). Cell rates, expected events,
    totals and coverage all come from that table; detail rows are never joined back.
    """
    dims = list(groups.values())
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cell])
    # Rows without a complete profile fall together; their cell columns play no part.
    profile = [F.when(F.col("_complete"), F.col(c)).alias(c) for c in cell]
    cells = (
        df.select(*time, *cell, *dims, F.col(event).cast("long").alias("_e"), complete.alias("_complete"))
        .select(*time, *profile, *dims, "_e", "_complete")
        .groupBy(*time, *cell, *dims, "_complete")
        .agg(F.count("*").alias("_n"), F.sum("_e").alias("_ev"))
    )
    whole_cell = Window.partitionBy(*time, *cell, "_complete")
    rated = cells.withColumns(
        {"_cell_n": F.sum("_n").over(whole_cell), "_cell_ev": F.sum("_ev").over(whole_cell)}
    )
    eligible = F.col("_complete") & (F.col("_cell_n") >= min_cell)
    share = F.col("_n") * F.col("_cell_ev").cast("double") / F.col("_cell_n").cast("double")
    parts = rated.select(
        *time,
        F.inline(
            F.array(
                *[F.struct(F.lit(name).alias("dimension"), F.col(c).cast("string").alias("grp")) for name, c in groups.items()]
            )
        ),
        F.col("_n").alias("_raw_n"),
        F.col("_ev").alias("_raw_ev"),
        F.when(eligible, F.col("_n")).otherwise(0).alias("_ok_n"),
        F.when(eligible, F.col("_ev")).otherwise(0).alias("_ok_ev"),
        F.when(eligible, share).otherwise(F.lit(0.0)).alias("_exp"),
    )
    sums = parts.groupBy(*time, "dimension", "grp").agg(
        F.sum("_raw_n").alias("_raw_n"),
        F.sum("_raw_ev").alias("_raw_ev"),
        F.sum("_ok_n").alias("n"),
        F.sum("_ok_ev").alias("observed"),
        F.sum("_exp").alias("expected"),
    )
    everybody = Window.partitionBy(*time, "dimension")
    ratio = F.try_divide(F.col("observed").cast("double"), F.col("expected"))
    totals = sums.withColumns(
        {
            "population": F.sum("_raw_n").over(everybody),
            "comparable": F.sum("n").over(everybody),
            "_all_ev": F.sum("observed").over(everybody),
        }
    ).where(F.col("n") > 0)
    overall = F.col("_all_ev").cast("double") / F.col("comparable").cast("double")
    rates = totals.withColumns(
        {
            "ratio": ratio,
            "overall_rate": overall,
            "observed_rate": F.col("observed").cast("double") / F.col("n").cast("double"),
            "raw_rate": F.col("_raw_ev").cast("double") / F.col("_raw_n").cast("double"),
        }
    )
    final = rates.withColumns(
        {
            "adjusted_rate": F.col("ratio") * F.col("overall_rate"),
            "raw_ratio": F.try_divide(F.col("raw_rate"), F.col("overall_rate")),
            "publishable": (F.col("n") >= min_group) & ~F.coalesce(F.col("grp").isin(*unpublished), F.lit(False)),
            "direction": F.when(F.col("ratio") > 1 + zone, "above")
            .when(F.col("ratio") < 1 - zone, "below")
            .otherwise("neutral"),
        }
    )
    return final.drop("_raw_n", "_raw_ev", "_all_ev")
