"""Near-duplicate vectors by a forest of random-projection trees.

Vectors of equal direction are one class from the start. In each tree a node splits its vectors at the median of
their projections on a random direction, one direction for each level of each tree; vectors between
the quantiles `SPILL` go to both sides, so a pair near a border stays together. Nodes of more than
`LEAF` vectors split on, level by level, all nodes at once; medians come from an aggregate over all
vectors of the node. A group of close vectors is split like any other.

Within the leaves all vectors are compared exactly, and a leaf hands on only a spanning star of each
group it has joined. The stars' components say which vectors belong together; links are then counted
among all members of a component, whether a leaf has brought them together or not. Members are dealt
to blocks, and every block of a large component meets every other in a task of its own; small
components share tasks. Links are counted without listing them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.components import components
from civiclake.llm.vectors import matrix, usable
from civiclake.sources.scratch import stage

TREES, LEVELS = 8, 40
LEAF = 1024
SPILL = (0.42, 0.58)
#: Rows of a leaf compared with all of it at once.
STRIP = 1024
#: Members of a component in a block, about; components up to this size share tasks.
BLOCK = 2048
#: Decimals of a unit vector's components up to which directions are equal.
DECIMALS = 12


def _projections(trees: int, levels: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals = None
        for batch in batches:
            vectors = matrix(batch.column("vector"))
            if not len(vectors):
                continue
            if normals is None:
                normals = np.random.default_rng(seed).normal(size=(vectors.shape[1], trees * levels))
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            p = pa.array((unit @ normals).ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("vec_id").to_numpy(), trees)),
                    pa.array(np.tile(np.arange(trees, dtype=np.int64), len(vectors))),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(p) + 1, levels), pa.int32()), p),
                ],
                ["vec_id", "tree", "p"],
            )

    return run


def leaves(vectors: DataFrame, *, trees: int = TREES, leaf: int = LEAF, spill: tuple[float, float] = SPILL, seed: int = 11) -> DataFrame:
    """`vec_id`, `home`: the leaves of each vector, numbered over all trees.

    A node's number is its path, a leading one and a bit per level, and below it the tree.
    """
    # A level leaves each side the upper quantile at most; medians are approximate, so some levels more.
    needed = np.log(max(vectors.count() / leaf, 1.0)) / -np.log(max(spill[1], 1 - spill[0]))
    levels = min(LEVELS, int(np.ceil(needed)) + 8)
    active = vectors.mapInArrow(_projections(trees, levels, seed), "vec_id long, tree long, p array<double>")
    active = stage(active.withColumn("node", F.lit(1).cast("long")), "projections")
    done = None
    p, rest = F.col("p")[0], F.slice("p", 2, levels).alias("p")  # directions used are dropped
    for level in range(levels):
        nodes = active.groupBy("tree", "node").agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx(p, F.array(*map(F.lit, spill)), F.lit(10_000)).alias("q"),
            (F.min(p) < F.max(p)).alias("differ"),
        )
        nodes = stage(nodes, "tree-nodes")
        last = level == levels - 1
        finished = (F.col("n") <= leaf) | F.lit(last)
        both = F.array(
            F.when((p <= F.col("q")[1]) & F.col("differ"), F.col("node") * 2),
            F.when((p >= F.col("q")[0]) | ~F.col("differ"), F.col("node") * 2 + 1),
        )
        moved = active.join(nodes, ["tree", "node"]).select(
            "vec_id", "tree", rest, F.explode(F.when(finished, F.array("node")).otherwise(F.array_compact(both))).alias("node"), finished.alias("finished")
        )
        moved = stage(moved, "tree-level")
        here = moved.where("finished").select("vec_id", (F.col("node") * trees + F.col("tree")).alias("home"))
        done = here if done is None else done.union(here)
        active = moved.where("not finished").drop("finished")
        if active.isEmpty():
            break
    return done


def _directions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rounded unit vectors as bytes."""
    for batch in batches:
        vectors = matrix(batch.column("vector"))
        if not len(vectors):
            continue
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
        unit = np.round(scaled / np.linalg.norm(scaled, axis=1, keepdims=True), DECIMALS) + 0.0  # no negative zeros
        keys = pa.array([row.tobytes() for row in unit], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), keys], ["vec_id", "vector", "direction"])


def _unit(rows: pa.Table) -> np.ndarray:
    vectors = matrix(rows.column("vector"))
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _join(least: float):
    """A star of each group a leaf joins: (`vec_id`, `other`)."""

    def run(rows: pa.Table) -> pa.Table:
        ids, unit = rows.column("vec_id").to_numpy(), _unit(rows)
        label = ids.copy()
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for start in range(0, len(ids), STRIP):
            pairs.append(np.nonzero(unit[start : start + STRIP] @ unit.T >= least))
        a = np.concatenate([i + STRIP * n for n, (i, _) in enumerate(pairs)])
        b = np.concatenate([j for _, j in pairs])
        while len(a):
            least_label = label.copy()
            np.minimum.at(least_label, a, label[b])
            if (least_label == label).all():
                break
            label = least_label
        some = np.flatnonzero(label != ids)
        return pa.table({"vec_id": ids[some], "other": label[some]})

    return run


def _count(least: float):
    """Links of the rows of a task: (`vec_id`, `links`). Rows of `side` 0 are linked with those of 1, or,
    where there are only rows of side 0, with each other; always within a component."""

    def run(rows: pa.Table) -> pa.Table:
        ids, unit = rows.column("vec_id").to_numpy(), _unit(rows)
        component = rows.column("component").to_numpy()
        copies = rows.column("copies").to_numpy()
        side = rows.column("side").to_numpy()
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1)
        alone = rows.column("alone")[0].as_py()
        if alone:
            b = a
        links = np.zeros(len(ids), np.int64)
        for start in range(0, len(a), STRIP):
            strip = a[start : start + STRIP]
            near = (unit[strip] @ unit[b].T >= least) & (component[strip][:, None] == component[b])
            if alone:
                near[strip[:, None] == b] = False
            else:
                links[b] += copies[strip] @ near
            links[strip] += near @ copies[b]
        some = np.flatnonzero(links)
        return pa.table({"vec_id": ids[some], "links": links[some]})

    return run


def _count_links(members: DataFrame, least: float) -> DataFrame:
    """`vec_id`, `links` of `members` (`vec_id`, `vector`, `copies`, `component`): how many others of the
    component are as close as `least`, copies counted. Every pair of a component is compared."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    rows = members.join(sizes, "component").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    few = rows.where("blocks = 1")
    tasks = max(1, -(-members.count() // BLOCK))
    shared = few.select(
        F.lit(-1).cast("long").alias("group"),
        F.pmod(F.xxhash64("component"), F.lit(tasks)).alias("one"),
        F.lit(-1).cast("long").alias("two"),
        F.lit(True).alias("alone"),
        F.lit(0).alias("side"),
        *members.columns,
    )
    # Each block goes once to every block, with the smaller number first.
    many = rows.where("blocks > 1").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = many.select(
        F.col("component").alias("group"),
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        (F.col("block") == F.col("other")).alias("alone"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
        *members.columns,
    )
    counted = shared.union(paired).groupBy("group", "one", "two").applyInArrow(_count(least), "vec_id long, links long")
    return counted.groupBy("vec_id").agg(F.sum("links").alias("links"))


def near_duplicates(table: DataFrame, *, least: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`key`, `n_links`, `component_id`, `kept` of every row of `table`.

    Two vectors are linked if their cosine is at least `least`. All links within a component are counted;
    missed are only those between vectors that no chain of leaves has joined. Which rows take part, and what repeated keys mean, is said in
    `vectors.usable`; all others have no links and are kept as their own component (null keys: null,
    not kept). Repeated rows come back as often. Other columns are ignored; an empty table gives an
    empty result.
    """
    rows = stage(usable(table, key, vector), "vectors")
    directions = rows.mapInArrow(_directions, "vec_id long, vector array<double>, direction binary")
    classes = directions.groupBy("direction").agg(
        F.min(F.struct("vec_id", "vector")).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    classes = stage(classes.select("direction", "first.vec_id", "first.vector", "copies"), "vector-classes")
    homes = leaves(classes.select("vec_id", "vector"))
    compared = (
        classes.select("vec_id", "vector").join(homes, "vec_id").groupBy("home").applyInArrow(_join(least), "vec_id long, other long")
    )
    joined = stage(components(compared.select(F.col("vec_id").alias("a"), F.col("other").alias("b"))), "vector-components")
    members = classes.join(joined, F.col("vec_id") == F.col("node")).select("vec_id", "vector", "copies", "component")
    links = _count_links(stage(members, "component-members"), least)
    of_class = (
        classes.join(links, "vec_id", "left")
        .join(joined, F.col("vec_id") == F.col("node"), "left")
        .select(
            "direction",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    of_vector = directions.join(of_class, "direction").select(F.col("vec_id").alias("node"), "n_links", "component_id")
    kind = table.schema[key].dataType
    return (
        table.select(F.col(key).cast("long").alias("vec_id"))
        .join(of_vector, F.col("vec_id") == F.col("node"), "left")
        .select(
            F.col("vec_id").cast(kind).alias(key),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
        )
    )
