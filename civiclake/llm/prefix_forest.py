"""Approximate nearest neighbours with a hash-prefix forest.

Each tree gives a vector a string of `BITS` bits: on which side of random hyperplanes, each through
the median of a bounded sample, it lies. A tree is the sorted array of the strings of the rows of one
shard. A query descends every tree to its longest matching prefix and then ascends in all trees at
once, one bit at a time, until the prefixes hold `WANTED` times as many entries as the shard has
rows, counted over all trees, and `LEAST` times `k` different rows, or the prefix is empty and all
rows are found. The query's own row counts for neither. The rows found are ranked by exact distance.

Rows are dealt to shards of about `SHARD` rows and queries to blocks of about `BLOCK`; every block
meets every shard, and the best of all shards are the answer. All rows are indexed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm.vectors import matrix, usable
from civiclake.sources.scratch import stage

TREES, BITS = 32, 32
SHARD, BLOCK = 8192, 1024
#: Entries to gather per shard, over all trees, as a multiple of its rows.
WANTED = 1.0
#: Different rows to gather per shard, at least, as a multiple of `k`.
LEAST = 10
#: Rows whose medians place the hyperplanes, at most: those with the smallest hashes.
SAMPLE = 4096


class Planes:
    """Random hyperplanes of all trees for vectors of one length."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.trees, self.bits = trees, bits
        self.normals = rng.normal(size=(sample.shape[1], trees * bits))
        self.offsets = np.median(sample @ self.normals, axis=0)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """A row of integers per tree; the first plane is the highest bit."""
        sides = (vectors @ self.normals > self.offsets).reshape(len(vectors), self.trees, self.bits)
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        return (sides * weights).sum(axis=2, dtype=np.uint64).T


class Forest:
    """The sorted arrays of one shard."""

    def __init__(self, planes: Planes, vectors: np.ndarray):
        self.planes, self.vectors = planes, vectors
        strings = planes.strings(vectors)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Where in each tree the entries stand that share the first `depth` bits of each query."""
        below = np.uint64((1 << (self.planes.bits - depth)) - 1)
        low = np.stack([np.searchsorted(own, s & ~below) for own, s in zip(self.sorted, strings, strict=True)])
        high = np.stack([np.searchsorted(own, s | below, "right") for own, s in zip(self.sorted, strings, strict=True)])
        return low, high

    def candidates(self, queries: np.ndarray, wanted: float, least: int, itself: np.ndarray) -> list[np.ndarray]:
        """Row numbers for each query, without the row `itself` says is its own (-1: none)."""
        strings = self.planes.strings(queries)
        found: list[np.ndarray | None] = [None] * len(queries)
        waiting = np.arange(len(queries))
        for depth in range(self.planes.bits, -1, -1):
            low, high = self.ranges(strings[:, waiting], depth)
            # Its own row stands once in each tree's prefix, at any depth.
            enough = (high - low).sum(axis=0) - self.planes.trees * (itself[waiting] >= 0) >= wanted
            for at in np.flatnonzero(enough).tolist():
                own = np.zeros(len(self.vectors), bool)
                for tree, (a, b) in enumerate(zip(low[:, at].tolist(), high[:, at].tolist(), strict=True)):
                    own[self.order[tree, a:b]] = True
                if itself[waiting[at]] >= 0:
                    own[itself[waiting[at]]] = False
                rows = np.flatnonzero(own)
                if len(rows) >= least:
                    found[waiting[at]] = rows
                else:
                    enough[at] = False
            waiting = waiting[~enough]
            if not len(waiting):
                break
        everything = np.arange(len(self.vectors))
        return [everything[everything != own] if f is None else f for f, own in zip(found, itself.tolist(), strict=True)]


def _search(planes: Planes, k: int, wanted: float):
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        ids, asked = (t.column("vec_id").to_numpy() for t in (rows, queries))
        out_query, out_id, out_score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if len(ids) and len(asked):
            vectors, targets = matrix(rows.column("vector")), matrix(queries.column("vector"))
            order = np.argsort(ids)
            at = order[np.minimum(np.searchsorted(ids, asked, sorter=order), len(ids) - 1)]
            itself = np.where(ids[at] == asked, at, -1)
            found = Forest(planes, vectors).candidates(targets, wanted * len(ids), LEAST * k, itself)
            for query, target, own in zip(asked.tolist(), targets, found, strict=True):
                score = np.sqrt(((vectors[own] - target) ** 2).sum(axis=1))
                best = np.lexsort((ids[own], score))[:k]
                out_query.append(np.full(len(best), query))
                out_id.append(ids[own[best]])
                out_score.append(score[best])
        return pa.table(
            {
                "query_id": pa.array(np.concatenate(out_query)),
                "vec_id": pa.array(np.concatenate(out_id)),
                "score": pa.array(np.concatenate(out_score)),
            }
        )

    return run


def nearest(
    table: DataFrame, queries, *, k: int = 10, key: str = "vec_id", vector: str = "embedding", wanted: float = WANTED
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the `k` nearest found by Euclidean distance.

    `queries` is a condition on `vec_id` that picks the queries among the rows. Ties go to the smaller
    id; where there are fewer candidates, all are returned. Which rows take part, and what repeated
    keys mean, is said in `vectors.usable`; all others are neither queries nor candidates. Other
    columns are ignored; a table without usable vectors gives an empty result.
    """
    rows = stage(usable(table, key, vector), "vectors")
    count, asked = rows.count(), rows.where(queries).count()
    spark = table.sparkSession
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    planes = Planes(matrix(sample.column("vector")))
    shards, blocks = -(-count // SHARD), -(-asked // BLOCK)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = rows.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), spread(blocks).alias("block"))
    sought = rows.where(queries).select(
        "vec_id", "vector", spread(shards).alias("shard"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    )
    found = (
        placed.groupBy("shard", "block")
        .cogroup(sought.groupBy("shard", "block"))
        .applyInArrow(_search(planes, k, wanted), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
