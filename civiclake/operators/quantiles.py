"""Exact quantiles of groups of any size, by distributed selection.

The built-in exact median keeps every distinct value of a group in one task. Here a group may
hold any share of the table, and its values may all be nearly equal:

1. values fall into order-preserving buckets about 0.1 % wide, and a histogram is built with
   map-side combining. Groups that overlap (a row counts for its district, its region and the whole) share one
   histogram of the finest cells, and are added up from it;
2. a running sum over the buckets of each group finds those that hold the wanted ranks;
3. a second scan counts the values in these buckets. It knows them by a bitmap of bounded size;
4. while a target bucket holds many different values, a histogram 4096 times finer is built inside it,
   and only the finer buckets that hold the ranks stay. After two such steps a bucket is so narrow
   that double precision has less than 300,000 values in it, so each is ranked in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.operators.digests import bitmap_of, within
from civiclake.sources.scratch import stage

#: Buckets per factor e of magnitude, and the shift that keeps positive values above zero.
_PER_E = 1000
_SHIFT = 800_000

#: How much finer each level of buckets is, and the finest level.
_FINER = 4096
_FINEST = 2

#: Different values in a bucket up to which it is not cut finer.
FEW_VALUES = 10_000


def value_bucket(value: Column, level: int = 0) -> Column:
    """Bucket number of a double, increasing with the value; NaN sorts last."""
    finer = _FINER**level
    size = F.floor(F.ln(F.abs(value)) * (_PER_E * finer)) + F.lit(_SHIFT * finer)
    beyond = 10 * _SHIFT * finer
    return (
        F.when(F.isnan(value), F.lit(2 * beyond))
        .when(value == 0, F.lit(0).cast("long"))
        .when(F.abs(value) == float("inf"), F.lit(beyond) * F.signum(value).cast("long"))
        .when(value > 0, size.cast("long"))
        .otherwise(-size.cast("long"))
    ).cast("long")


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[part for c in columns for part in (F.isnull(c), F.col(c))])


def _holds(rank: str, before: str, count: str) -> Column:
    return (F.col(rank) >= F.col(before)) & (F.col(rank) < F.col(before) + F.col(count))


def _holding(histogram: DataFrame, place: Sequence[str]) -> DataFrame:
    """Of the ordered cells `_b` of each `place`, with `_n` rows each and `_base` rows before all of them, those that hold a wanted rank."""
    running = Window.partitionBy(*place).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = histogram.withColumn("_before", F.col("_base") + F.sum("_n").over(running) - F.col("_n"))
    return counted.where(_holds("_lo", "_before", "_n") | _holds("_hi", "_before", "_n"))


def _in_buckets(counted: DataFrame, targets: DataFrame, bucket: Sequence[str]) -> DataFrame:
    """Values in the target buckets, and perhaps a few in others."""
    return within(counted, _hash(bucket), bitmap_of(targets.select(_hash(bucket).alias("bucket")), "bucket", targets.count()))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    fractions: Mapping[str, float] | float = 0.5,
    cells: Sequence[str] | None = None,
    expand: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per group with the interpolated quantile of each measure and its `n_<measure>`.

    NULL values are ignored, as in `percentile`. `fractions` is one number for all measures
    or one per measure. A group without any value in any measure is absent. For groups that overlap,
    `cells` are the columns of the finest cells and `expand` gives each row of a table with these columns
    once for every group it belongs to, with the columns `keys`.
    """
    wanted = {m: (fractions[m] if isinstance(fractions, Mapping) else fractions) for m in measures}
    cells = list(keys if cells is None else cells)
    expand = expand or (lambda rows: rows)
    values = F.array(
        *[
            F.struct(F.lit(name).alias("_m"), column.cast("double").alias("_v"))
            for name, column in measures.items()
        ]
    )
    long = df.select(*cells, F.inline(values)).where(F.col("_v").isNotNull()).withColumn("_b", value_bucket(F.col("_v")))
    group, bucket = [*keys, "_m"], [*keys, "_m", "_b"]
    about = ["_total", "_pos", "_lo", "_hi"]

    histogram = stage(long.groupBy(*cells, "_m", "_b").agg(F.count("*").alias("_n")), "histogram")
    by_group = expand(histogram)
    summed = by_group.groupBy(*bucket).agg(F.sum("_n").alias("_n"))
    fraction = reduce(
        lambda expr, item: F.when(F.col("_m") == item[0], F.lit(float(item[1]))).otherwise(expr),
        wanted.items(),
        F.lit(None).cast("double"),
    )
    ranked = (
        summed.withColumn("_total", F.sum("_n").over(Window.partitionBy(*group)))
        .withColumn("_pos", fraction * (F.col("_total") - 1))
        .withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos"), "_base": F.lit(0).cast("long")})
    )
    targets = stage(_holding(ranked, group).select(*bucket, "_before", *about), "quantile-buckets")

    # The cells that some group wants a bucket of; the second scan counts the values in those.
    asked = by_group.join(targets, _same(by_group, targets, bucket), "left_semi")
    asked = asked.select(_hash([*cells, "_m", "_b"]).alias("cell"))
    inside = within(long, _hash([*cells, "_m", "_b"]), bitmap_of(asked, "cell", histogram.count()))
    counted = expand(inside.groupBy(*cells, "_m", "_v").agg(F.count("*").alias("_n"))).groupBy(*group, "_v").agg(F.sum("_n").alias("_n"))
    counted = stage(_in_buckets(counted.withColumn("_b", value_bucket(F.col("_v"))), targets, bucket), "quantile-values")

    for level in range(1, _FINEST + 1):
        widest = counted.groupBy(*bucket).count().agg(F.max("count")).first()[0]
        if (widest or 0) <= FEW_VALUES:
            break
        counted = counted.withColumnsRenamed({"_b": "_outer"}).withColumn("_b", value_bucket(F.col("_v"), level))
        finer = counted.groupBy(*group, "_outer", "_b").agg(F.sum("_n").alias("_n"))
        outer = targets.withColumnsRenamed({"_b": "_outer", "_before": "_base"})
        known = finer.join(outer, _same(finer, outer, [*group, "_outer"])).select(
            *[finer[c] for c in (*group, "_outer", "_b", "_n")], "_base", *about
        )
        targets = stage(_holding(known, [*group, "_outer"]).select(*bucket, "_before", *about), "quantile-buckets")
        counted = _in_buckets(counted.drop("_outer"), targets, bucket)

    hits = counted.join(targets, _same(counted, targets, bucket)).select(*[counted[c] for c in (*bucket, "_v", "_n")], "_before", *about)
    running = Window.partitionBy(*bucket).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = hits.withColumn("_start", F.col("_before") + F.sum("_n").over(running) - F.col("_n"))
    low = F.max(F.when(_holds("_lo", "_start", "_n"), F.col("_v")))
    high = F.max(F.when(_holds("_hi", "_start", "_n"), F.col("_v")))
    weight = F.max(F.col("_pos") - F.col("_lo"))
    per_measure = at.groupBy(*group).agg(
        low.alias("_low"), high.alias("_high"), weight.alias("_w"), F.max("_total").alias("_total")
    )
    value = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_w")
    pivot = []
    for name in measures:
        mine = F.col("_m") == name
        pivot.append(F.max(F.when(mine, value)).alias(name))
        pivot.append(F.coalesce(F.max(F.when(mine, F.col("_total"))), F.lit(0).cast("long")).alias(f"n_{name}"))
    return per_measure.groupBy(*keys).agg(*pivot) if keys else per_measure.agg(*pivot)
