"""Hard-negative mining: exact inner products in a residue number system.

Scores are inner products of integer vectors. Each component matrix is reduced modulo several small
primes, to residues so small that float32 matrix products of them are exact; the Chinese remainder
theorem (by mixed radix digits, in int64) turns the residues of a product into the signed score.

Anchors, in blocks, meet all rows, in shards: a task holds one block and one shard and works through
tiles of their score matrix. The first pass finds each anchor's positives. The second, with the
positives' scores known, keeps the first rows of other labels within each positive's window of scores.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.sources.scratch import stage

SCALE = 256

#: Components in a shard of rows and in a block of anchors: 8 and 16 MB of integers.
SHARD_CELLS = 2**20
BLOCK_CELLS = 2**21

#: Rows a shard has at least, unless there are fewer.
SHARD_LEAST = 512

#: Anchors and rows of a tile.
TILE = (256, 4096)

#: Squared lengths stay below this, so a hundred times a score fits int64.
LONGEST = 2**56

#: Takes the place of a score that a selection must not choose.
_NEVER = np.iinfo(np.int64).min


def primes(size: int, bound: int) -> list[int]:
    """The largest primes whose residues keep float32 products of `size` components exact, as many as scores up to `bound` need.

    Residues lie within (p - 1) / 2 of zero, so sums stay within `size` times its square, below 2^24.
    """
    most = 2 * math.isqrt((2**24 - 1) // max(size, 1)) + 1
    found, product, p = [], 1, most + 1
    while product <= 2 * bound:
        p -= 1
        if p < 2:
            raise ValueError(f"vectors of {size} components are too long for float32 residues")
        if all(p % d for d in range(2, math.isqrt(p) + 1)):
            found.append(p)
            product *= p
    return found


def residues(values: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    """`values` modulo each prime, as float32 between -(p - 1) / 2 and p / 2."""
    found = []
    for p in moduli:
        rest = values % p
        found.append((rest - p * (rest > p // 2)).astype(np.float32))
    return found


def scores(a: list[np.ndarray], b: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """The inner products (int64) of all rows whose residues `a` and `b` hold."""
    total = np.zeros((len(a[0]), len(b[0])), dtype=np.int64)
    weight = 1
    for x, y, p in zip(a, b, moduli, strict=True):
        # The next mixed radix digit: what the digits so far leave of this residue, over their weight.
        digit = ((x @ y.T).astype(np.int64) - total) % p * pow(weight, -1, p) % p
        total += digit * weight
        weight *= p
    total -= weight * (total > weight // 2)
    return total


def _first(found: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each line its `count` largest scores, of equal ones the leftmost: line, place, score. Changes `found`."""
    lines = np.arange(len(found))
    took = []
    for _ in range(min(count, found.shape[1])):
        place = found.argmax(axis=1)
        score = found[lines, place]
        some = score != _NEVER
        if not some.any():
            break
        took.append((lines[some], place[some], score[some]))
        found[lines[some], place[some]] = _NEVER
    return tuple(map(np.concatenate, zip(*took, strict=True))) if took else tuple(np.zeros((3, 0), dtype=np.int64))


def _matrix(table: pa.Table, size: int) -> np.ndarray:
    return np.asarray(table["vector"].combine_chunks().flatten().to_numpy(), dtype=np.int64).reshape(-1, size)


def _tiles(anchors: pa.Table, rows: pa.Table, size: int, moduli: list[int]):
    """Slices of anchors and rows and their scores, rows by id; `rows` is sorted by the caller."""
    left, right = _matrix(anchors, size), _matrix(rows, size)
    for i in range(0, len(left), TILE[0]):
        a = residues(left[i : i + TILE[0]], moduli)
        for j in range(0, len(right), TILE[1]):
            yield slice(i, i + TILE[0]), slice(j, j + TILE[1]), scores(a, residues(right[j : j + TILE[1]], moduli), moduli)


def _labels(anchors: pa.Table, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Labels as numbers that are equal for equal labels."""
    both = pa.concat_arrays([anchors["label"].combine_chunks(), rows["label"].combine_chunks()]).dictionary_encode()
    codes = both.indices.to_numpy()
    return codes[: len(anchors)], codes[len(anchors) :]


def prepared(table: DataFrame, key: str, vector: str, label: Column, scale: int) -> tuple[DataFrame, int]:
    """`vec_id`, `label`, `vector` (integers) of the rows that take part, staged, and the vectors' length."""
    rows = table.select(F.col(key).cast("long").alias("vec_id"), label.alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < math.sqrt(LONGEST)))
    good = rows.where("vec_id is not null and label is not null and vector is not null").where(finite & (F.size("vector") > 0))
    whole = good.select("vec_id", "label", F.transform("vector", lambda x: F.floor(x * scale)).alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    one = whole.where(square < LONGEST).groupBy("vec_id").agg(F.min(F.struct("vector", "label")).alias("row"))
    staged = stage(one.select("vec_id", "row.label", "row.vector"), "scaled-vectors")
    sizes = staged.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    return staged.where(F.size("vector") == size), size


def mine(
    table: DataFrame, anchors: str, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    n_positives: int = 5, n_negatives: int = 5, least_percent: int = 80, scale: int = SCALE,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    `anchors` is a condition on `vec_id`. A row's score is the inner product of its components times `scale`, rounded
    down, with the anchor's; higher scores come first, ties by smaller id. An anchor's first `n_positives` other rows of its
    label are its positives; each has its first `n_negatives` rows of other labels whose scores lie between `least_percent` percent
    of its score and its score.

    Left out: rows with a null id, label or vector, with an empty vector, null or non-finite components, or a squared length of 2^56
    or more (scores times a hundred could leave 64 bits), and vectors of another length than most (of equally frequent lengths the longest
    counts). A repeated id takes part once, with its least vector, then least label. Zero vectors take part.
    """
    rows, size = prepared(table, key, vector, F.col(label) if isinstance(label, str) else label, scale)
    asked = stage(rows.where(anchors), "anchors")
    n_rows, n_asked = rows.count(), asked.count()
    longest = rows.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()[0] or 0.0
    moduli = primes(size, int(longest * (1 + 2**-40)) + 1)  # Cauchy and Schwarz: no score is beyond the longest square
    spread = min(rows.sparkSession.sparkContext.defaultParallelism, n_rows // SHARD_LEAST)
    shards = max(-(-n_rows * size // SHARD_CELLS), spread, 1)
    blocks = max(-(-n_asked * size // BLOCK_CELLS), 1)

    own_shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    own_block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int").alias("block")
    sharded = rows.select("*", own_shard, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")

    def positives_within(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("vec_id")
        ids, others = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        own, theirs = _labels(left, right)
        found = []
        for i, j, s in _tiles(left, right, size, moduli):
            s[(own[i, None] != theirs[None, j]) | (ids[i, None] == others[None, j])] = _NEVER
            line, place, score = _first(s, n_positives)
            found.append((ids[i][line], others[j][place], score))
        return pa.table([np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []], schema=arrow("anchor_id", "positive_id", "positive_score"))

    def negatives_within(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("vec_id")
        ids, others = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        own, theirs = _labels(left, right)
        wanted = left["positives"].to_pylist()
        found = []
        for i, j, s in _tiles(left, right, size, moduli):
            s[own[i, None] == theirs[None, j]] = _NEVER
            lists = wanted[i]
            for n in range(max(map(len, lists), default=0)):
                line = np.array([k for k, one in enumerate(lists) if len(one) > n])
                positive, top = (np.array([lists[k][n][c] for k in line], dtype=np.int64) for c in ("positive_id", "positive_score"))
                near = s[line]
                near[(near > top[:, None]) | (near == _NEVER) | (100 * np.maximum(near, -LONGEST) < least_percent * top[:, None])] = _NEVER
                at, place, score = _first(near, n_negatives)
                found.append((ids[i][line[at]], positive[at], top[at], others[j][place], score))
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table([np.concatenate(c) for c in zip(*found, strict=True)] if found else [[]] * 5, schema=arrow(*names))

    def arrow(*names: str) -> pa.Schema:
        return pa.schema([(n, pa.int64()) for n in names])

    def longs(*names: str) -> T.StructType:
        return T.StructType([T.StructField(n, T.LongType()) for n in names])

    def against_all(left: DataFrame, work, *names: str) -> DataFrame:
        placed = left.select("*", own_block, every_shard).groupBy("block", "shard")
        return placed.cogroup(sharded.groupBy("block", "shard")).applyInArrow(work, longs(*names))

    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = (
        against_all(asked, positives_within, "anchor_id", "positive_id", "positive_score")
        .withColumn("nth", F.row_number().over(best))
        .where(F.col("nth") <= n_positives)
        .groupBy(F.col("anchor_id").alias("vec_id"))
        .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    )
    ready = stage(asked.join(positives, "vec_id"), "anchors-with-positives")
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        against_all(ready, negatives_within, "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n_negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
