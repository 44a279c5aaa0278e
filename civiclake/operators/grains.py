"""The same metrics for the whole area, for each region and for each district, in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Grain:
    """A level of place. `column` None is the whole area, called `whole`; `exclude` lists
    place values that are not real places."""

    name: str
    column: str | None = None
    whole: str = "ALL"
    exclude: tuple[str, ...] = ()


def by_grain(
    df: DataFrame,
    time: Sequence[str],
    grains: Sequence[Grain],
    aggs: Sequence[Column],
    dims: Sequence[str] = (),
) -> DataFrame:
    """Additive metrics per (time, grain, place, dims) with grouping sets: one scan, one shuffle.

    Rows without a place, or with an excluded one, count for the whole area only. A NULL
    place is told from a rolled-up one by grouping_id.
    """
    base = [*time, *dims]
    places = [g.column for g in grains if g.column]
    sets = [[*base, g.column] if g.column else base for g in grains]
    keys = [F.col(c) for c in [*base, *places]]
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        *aggs, *[F.grouping(c).alias(f"_rolled_{c}") for c in places]
    )
    cases = []
    for g in grains:
        if g.column:
            here = F.col(f"_rolled_{g.column}") == 0
            good = F.col(g.column).isNotNull() & ~F.col(g.column).isin(*g.exclude)
            good = good if g.exclude else F.col(g.column).isNotNull()
            cases.append((here & good, g.name, F.col(g.column)))
        else:
            all_rolled = reduce(lambda a, b: a & b, [F.col(f"_rolled_{c}") == 1 for c in places], F.lit(True))
            cases.append((all_rolled, g.name, F.lit(g.whole)))
    grain = reduce(lambda e, c: F.when(c[0], F.lit(c[1])).otherwise(e), cases, F.lit(None).cast("string"))
    place = reduce(lambda e, c: F.when(c[0], c[2]).otherwise(e), cases, F.lit(None).cast("string"))
    helper = [f"_rolled_{c}" for c in places]
    return (
        grouped.withColumns({"grain": grain, "place": place})
        .where(F.col("grain").isNotNull())
        .drop(*places, *helper)
    )


def expand_grains(df: DataFrame, grains: Sequence[Grain]) -> DataFrame:
    """Each row once per grain it counts for, with `grain` and `place`."""
    levels = []
    for g in grains:
        place = F.col(g.column) if g.column else F.lit(g.whole)
        if g.exclude:
            place = F.when(~place.isin(*g.exclude), place)
        levels.append(F.struct(F.lit(g.name).alias("grain"), place.alias("place")))
    return df.select("*", F.inline(F.array(*levels))).where(F.col("place").isNotNull())


def quantiles_by_grain(
    df: DataFrame,
    time: Sequence[str],
    grains: Sequence[Grain],
    measures: Mapping[str, Column],
    dims: Sequence[str] = (),
    fractions: Mapping[str, float] | float = 0.5,
) -> DataFrame:
    """Exact quantiles per (time, grain, place, dims).

    Rows are counted in the finest cells, all place columns together; the grains are added up from those.
    """
    places = list(dict.fromkeys(g.column for g in grains if g.column))
    return exact_quantiles(
        df,
        [*time, "grain", "place", *dims],
        measures,
        fractions,
        cells=[*time, *dims, *places],
        expand=lambda rows: expand_grains(rows, grains),
    )


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join aggregates on keys that may be NULL; the keys appear once."""
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])
    rest = [right[c] for c in right.columns if c not in keys]
    return left.join(right, same, how).select(*[left[c] for c in left.columns], *rest)
