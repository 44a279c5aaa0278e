"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.sources.scratch import stage


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (the smallest node it reaches) for every node of the edges `a`, `b`.

    Alternating stars: every node first ties its larger neighbours to its smallest neighbour, then
    its smaller ones, until every edge points to the smallest node. Each round is two aggregates
    and two joins over the edges and is written out, so a lost executor costs one round at most.
    The number of rounds grows with the logarithm of the longest path.
    """
    current = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while before != (now := current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()):
        before = now
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large, "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # Each node keeps its smallest neighbour and hands it to its other smaller ones.
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        current = stage(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
