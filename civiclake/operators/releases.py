"""Release management: which release of a period is current, was visible, comes next.

A registry has one row per (period, release) with its `maturity` (0 is the least mature) and
`frozen_at`, the day the publisher froze it. All releases stay stored as partitions, so a read
as of a date is a choice of partitions and never expires.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.operators.ranking import latest_per_key
from civiclake.sources.scratch import stage

#: Registry entries up to which a choice of releases is written into the scan as a predicate.
LISTED_PAIRS = 1000


class UnknownRelease(ValueError):
    """A release that the registry does not list."""


def check_release(registry: DataFrame, period: str, year: int, release: str) -> None:
    """Raise unless (year, release) is registered. Values are compared as Columns, never
    pasted into SQL text."""
    known = registry.where((F.col(period) == F.lit(year)) & (F.col("release") == F.lit(release)))
    if known.limit(1).count() == 0:
        raise UnknownRelease(f"no release {release!r} for {year!r}")


def latest_registration(log: DataFrame, period: str, at: str = "applied_at") -> DataFrame:
    """The registry from its append-only log: the last row per (period, release) counts."""
    return latest_per_key(log, [period, "release"], [F.desc(at)])


def switched_to(log: DataFrame, period: str, at: str = "applied_at") -> DataFrame:
    """Per period, the release that was made current last. A forced switch may go back to a less
    mature one; registrations that only store a release do not count."""
    return latest_per_key(log.where("made_current"), [period], [F.desc(at)])


def most_mature(registry: DataFrame, period: str, also: Sequence[str] = ()) -> DataFrame:
    return latest_per_key(registry, [*also, period], [F.desc("maturity"), F.desc("frozen_at")])


def visible_at(registry: DataFrame, period: str, day: date | Column) -> DataFrame:
    """Per period, the release an analyst saw on `day`: the most mature one frozen by then."""
    limit = F.lit(day) if isinstance(day, date) else day
    return most_mature(registry.where(F.col("frozen_at") <= limit), period)


def visible_on_days(registry: DataFrame, period: str, days: Sequence[date]) -> DataFrame:
    """The same for several days at once, as (as_of, period, release, ...)."""
    asked = registry.select("*", F.explode(F.array(*[F.lit(d) for d in days])).alias("as_of"))
    return most_mature(asked.where(F.col("frozen_at") <= F.col("as_of")), period, ["as_of"])


def read_releases(table: DataFrame, chosen: DataFrame, period: str) -> DataFrame:
    """Rows of the chosen (period, release) pairs.

    The pairs are registry entries. They are staged and counted: a short list becomes a
    predicate, so that the scan of a table stored by (period, release) opens only these
    partitions; a long one is joined by its measured size.
    """
    pairs = stage(chosen.select(period, "release").distinct(), "chosen-releases")
    if pairs.count() > LISTED_PAIRS:
        return table.join(pairs, [period, "release"], "left_semi").select(*table.columns)
    wanted = [
        (F.col(period) == F.lit(p)) & (F.col("release") == F.lit(r)) for p, r in pairs.collect()
    ]
    return table.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def current(table: DataFrame, registry: DataFrame, period: str) -> DataFrame:
    return read_releases(table, most_mature(registry, period), period)


def as_of(table: DataFrame, registry: DataFrame, period: str, day: date) -> DataFrame:
    return read_releases(table, visible_at(registry, period, day), period)


def publication_order(registry: DataFrame, period: str) -> DataFrame:
    """Position of each release in the order of publication, and whether it took effect.

    A release takes effect when it is more mature than everything published for its period
    before. The registry has one row per (period, release), so numbering it in one place is
    bounded by its definition.
    """
    order = [F.col("frozen_at"), F.col(period), F.col("maturity")]
    earlier = (
        Window.partitionBy(period)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.max("maturity").over(earlier)
    return registry.withColumns(
        {
            "position": F.row_number().over(Window.orderBy(*order)),
            "takes_effect": F.coalesce(F.col("maturity") > before, F.lit(True)),
        }
    )


def scope(registry: DataFrame, period: str, all_releases_for: Sequence[int] = ()) -> DataFrame:
    """The most mature release of each period, plus every release of the chosen periods."""
    top = F.max("maturity").over(Window.partitionBy(period))
    wanted = F.col("maturity") == F.col("_top")
    if all_releases_for:
        wanted = wanted | F.col(period).isin(*all_releases_for)
    return registry.withColumn("_top", top).where(wanted).drop("_top")


def application_plan(
    candidates: DataFrame, applied: DataFrame, period: str, force: bool = False
) -> DataFrame:
    """What applying each candidate would do, given the current release per period.

    'apply', or 'already current' / 'current is more mature' (nothing to do) unless forced.
    """
    now = applied.select(period, F.col("release").alias("_now"), F.col("maturity").alias("_level"))
    action = (
        F.when(F.lit(force) | F.col("_now").isNull(), "apply")
        .when(F.col("_now") == F.col("release"), "already current")
        .when(F.col("_level") > F.col("maturity"), "current is more mature")
        .otherwise("apply")
    )
    return candidates.join(now, period, "left").withColumn("action", action).drop("_now", "_level")


def release_delta(counts: DataFrame, period: str, n: str) -> DataFrame:
    """Change of a count from each release of a period to the next more mature one."""
    order = Window.partitionBy(period).orderBy("maturity")
    return counts.withColumn("added", F.col(n) - F.lag(n).over(order))


def next_candidates(registry: DataFrame, period: str) -> DataFrame:
    """Per kind of release, the next period that is not registered yet."""
    return registry.groupBy("release").agg((F.max(period) + 1).alias(period))
