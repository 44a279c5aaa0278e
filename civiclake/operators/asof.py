"""As-of join: each (entity, time) row gets the last record of its entity's history up to that time.

No range join and no row for every day in between. Time is cut into buckets; the last record of each
(entity, bucket) is carried into the buckets after it, over one row for each bucket. Rows then meet
only the records of their own bucket, after the carried one, in one pass in the order of time. A bucket of an
entity with very many rows is dealt over several tasks, each with all of its few records.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.sources.scratch import stage

#: An (entity, bucket) is dealt over several tasks if it has at least one in so many of all rows (at
#: most so many do) and at least `HOT_LEAST`; each task then gets about that least number.
HOT_SHARE = 1024
HOT_LEAST = 100_000


def as_of_join(
    rows: DataFrame,
    history: DataFrame,
    entity: Sequence[str],
    time: str,
    since: str,
    values: Sequence[str],
    bucket: Callable[[Column], Column] = F.year,
) -> DataFrame:
    """`rows` with the `values` of the record in force: the latest one whose `since` is not after `time`.

    Of records with the same `since` the one with the greatest `values`, in their order, is in force. Rows before the
    first record, and rows with a null entity or time, have nulls. Repeated rows stay. `bucket` must not decrease with
    time.
    """
    keys = [f"_e{i}" for i in range(len(entity))]
    none = F.lit(None)
    whole = F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row")
    asked = rows.select(*(F.col(c).alias(k) for c, k in zip(entity, keys, strict=True)), F.col(time).alias("_t"), whole)
    known = asked.where(" AND ".join(f"{c} IS NOT NULL" for c in (*keys, "_t"))).withColumn("_b", bucket(F.col("_t")))
    records = history.select(*(F.col(c).alias(k) for c, k in zip(entity, keys, strict=True)), F.col(since).alias("_t"), F.struct(*values).alias("_v"))
    records = records.where(" AND ".join(f"{c} IS NOT NULL" for c in (*keys, "_t"))).withColumn("_b", bucket(F.col("_t")))
    place = [*keys, "_b"]

    sizes = stage(known.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")), "as-of-buckets")
    last = records.groupBy(*place).agg(F.max(F.struct("_t", "_v")).alias("_last"))
    spine = sizes.join(last, place, "full_outer")
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    opening = spine.select(*place, "_n", F.last("_last", ignorenulls=True).over(before).alias("_first")).where("_n IS NOT NULL AND _first IS NOT NULL")
    own = records.join(sizes.select(*place), place, "left_semi")
    facts = own.select(*place, "_t", "_v").unionByName(opening.select(*place, "_first._t", "_first._v"))

    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = sizes.where(F.col("_n") >= max(-(-total // HOT_SHARE), HOT_LEAST)).select(*place, F.ceil(F.col("_n") / HOT_LEAST).cast("int").alias("_tasks"))
    hot = F.broadcast(hot)
    tasks = F.coalesce("_tasks", F.lit(1))
    dealt = known.join(hot, place, "left").withColumn("_s", F.pmod(F.monotonically_increasing_id(), tasks).cast("int"))
    copied = facts.join(hot, place, "left").withColumn("_s", F.explode(F.sequence(F.lit(0), tasks - 1)))

    both = dealt.select(*place, "_s", "_t", none.cast(records.schema["_v"].dataType).alias("_v"), "_row").unionByName(
        copied.select(*place, "_s", "_t", "_v", none.cast(asked.schema["_row"].dataType).alias("_row"))
    )
    up_to = Window.partitionBy(*place, "_s").orderBy("_t", F.col("_row").isNotNull(), "_v").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_v", F.last("_v", ignorenulls=True).over(up_to)).where("_row IS NOT NULL").select("_row", "_v")
    rest = asked.where(" OR ".join(f"{c} IS NULL" for c in (*keys, "_t"))).select("_row", none.cast(records.schema["_v"].dataType).alias("_v"))
    return found.unionByName(rest).select(*(F.col(f"_row.`{c}`") for c in rows.columns), *(F.col(f"_v.{v}").alias(v) for v in values))
