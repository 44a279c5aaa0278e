"""Jaccard self-join on n-gram sets with a prefix tree.

Elements of all sets have one global order, rare ones first: by the number of documents in the
element's bucket (a table of `BUCKETS` counts over all documents), then by hash. If two sets are
similar enough, each has one of their common elements within its prefix, the first
n - ceil(t n) + 1 elements.

1. Sets whose prefixes share an element, and whose sizes and places there allow the similarity,
   are candidates. They are compared with few pivots instead of in pairs: two rounds compare the
   sets of each shared element and size band with those that come first in a few orders of all
   sets, and one more round compares all those that are still in different
   components, in cells of bounded size.
2. Each set has a sketch of at least twice as many bits as elements: the parity of the elements in
   each place. An element that only one of two sets has changes one bit, so sketches that differ in
   more bits than similar sets may differ in elements rule a candidate out before any text is fetched.
3. Candidates of a pivot are stored in a prefix tree by the global order. The pivot descends it
   once, so sets with a common beginning share the overlap counted so far, and a subtree is left
   when the remaining lengths can no longer bring the overlap needed.

Equal sets are one class from the start. Links are exact; a component's label is its smallest key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclake.llm.chunks import byte_values, drop_kept, words
from civiclake.llm.components import components
from civiclake.llm.grams import Sequence, signed, word_hashes
from civiclake.operators.digests import bitmap_of, within
from civiclake.sources.scratch import stage

#: Places of the table of document counts that orders the elements; 4 bytes each.
BUCKETS = 1 << 20
_SLICE = 1 << 12
#: Candidates of one pivot that share a tree.
TREE = 256
#: Sets of one element in a part; two parts are compared at once.
PART = 512
#: The rounds with pivots: the orders they come first in (None: by place, else the seed of a hash), and where size bands begin.
PIVOTS = (((None,), 0.0), ((None, 1), 0.5))
#: Of the elements that a set and its pivot have to share, one in so many must have that pivot; the others may have different ones.
WITH_PIVOT = 3
#: Similarity, as (numerator, denominator).
THRESHOLD = (3, 4)

_HALF = 1 << 31


def shingles(data: bytes | None, length: int = 5) -> np.ndarray:
    """The distinct n-grams of a text, A-Z lower-cased, as ascending hashes."""
    own = words(data.lower() if data else None)
    if not own:
        return np.empty(0, np.uint64)
    every = np.sort(Sequence(word_hashes(own)[0]).grams(min(length, len(own))))
    return every[np.append(True, every[1:] != every[:-1])]


def set_name(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The parity of the elements in each place, as 64-bit integers; their number is a power of two."""
    places = 1 << max(6, (2 * len(elements) - 1).bit_length())
    odd = np.bincount((elements & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def overlap_needed(a, b):
    """The least common elements with which sets of these sizes are similar enough."""
    n, d = THRESHOLD
    return -(-n * (a + b) // (n + d))


def _slices(counts: np.ndarray) -> pa.RecordBatch:
    parts = [part.tobytes() for part in np.minimum(counts, np.uint64(2**32 - 1)).astype("<u4").reshape(-1, _SLICE)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = np.frombuffer(part, "<u4").astype(np.uint64)
            sums[number] = sums[number] + counts if number in sums else counts
    parts = [np.minimum(s, 2**32 - 1).astype("<u4").tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])


def document_counts(named: DataFrame) -> np.ndarray:
    """Documents per bucket of elements, over all documents: `BUCKETS` numbers."""
    parts = named.where("slice is not null").select("slice", "counts").repartition("slice")
    counts = np.zeros(BUCKETS, np.uint32)
    for row in parts.mapInArrow(_sum_slices, "slice int, counts binary").collect():  # BUCKETS / _SLICE rows
        counts[row.slice * _SLICE : (row.slice + 1) * _SLICE] = np.frombuffer(row.counts, "<u4")
    return counts


def ordered(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set in the global order."""
    return elements[np.lexsort((elements, counts[(elements % np.uint64(BUCKETS)).astype(np.int64)]))]


_NAMED = "doc long, version long, n_shingles long, name long, sketch array<long>, slice int, counts binary"


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with the name and sketch of its set, and at the end the task's documents per bucket."""
    drop_kept()
    counts = np.zeros(BUCKETS, np.uint64)
    waiting, size = [np.empty(0, np.uint64)], 0

    def add() -> None:
        buckets = (np.concatenate(waiting) % np.uint64(BUCKETS)).astype(np.int64)
        np.add(counts, np.bincount(buckets, minlength=BUCKETS).astype(np.uint64), out=counts)

    for batch in batches:
        sizes, names, sketches = [], [], []
        for data in byte_values(batch.column("text")):
            own = shingles(data)
            sizes.append(len(own))
            names.append(set_name(own) if len(own) else None)
            sketches.append(sketch(own) if len(own) else None)
            waiting.append(own)
            size += len(own)
            if size > 1 << 21:
                add()
                waiting, size = [np.empty(0, np.uint64)], 0
        none = pa.nulls(len(sizes))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                batch.column("version"),
                pa.array(sizes, pa.int64()),
                pa.array(names, pa.int64()),
                pa.array(sketches, pa.list_(pa.int64())),
                none.cast(pa.int32()),
                none.cast(pa.binary()),
            ],
            ["doc", "version", "n_shingles", "name", "sketch", "slice", "counts"],
        )
    add()
    slices = _slices(counts)
    none = pa.nulls(slices.num_rows)
    nulls = [none.cast(pa.int64())] * 4 + [none.cast(pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(nulls + slices.columns, ["doc", "version", "n_shingles", "name", "sketch", "slice", "counts"])


def _prefixes(shared):
    """Rows (element, name, place * 2**31 + size) for each element of the prefixes of a task's distinct sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        counts = shared.value
        n, d = THRESHOLD
        for batch in batches:
            elements, names, places = [np.empty(0, np.uint64)], [], []
            seen = set()
            for data in byte_values(batch.column("text")):
                own = shingles(data)
                size = len(own)
                if not size or (name := set_name(own)) in seen:
                    continue
                seen.add(name)
                prefix = size + (-n * size // d) + 1
                elements.append(ordered(own, counts)[:prefix])
                names.append(np.full(prefix, name))
                places.append(np.arange(prefix) * _HALF + size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate(elements))),
                    pa.array(np.concatenate(names) if names else [], pa.int64()),
                    pa.array(np.concatenate(places) if places else [], pa.int64()),
                ],
                ["element", "name", "place"],
            )

    return run


_ENTRY = "element long, name long, place long"


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by element, size and name: those with a set beside them that `_may_link` admits.

    What a row has left from its place on must reach the least partner of the larger size. Of the larger sets the
    next one asks for least; of the smaller ones that with most left will do.
    """
    held, given, most = None, True, 0  # the last row so far, whether it was passed on, and most left among its element's rows
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        if not rows.shape[1]:
            continue
        new = np.ones(rows.shape[1], bool)
        new[1:] = (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)
        rows = rows[:, new]  # copies of a set from different tasks
        size = rows[2] % _HALF
        left, partner = size - rows[2] // _HALF, _least_size(size)
        same = np.diff(rows[0]) == 0
        group = np.cumsum(np.append(0, ~same))
        upper = group * _HALF + left
        if held is not None:
            upper[0] = most
        upper = np.maximum.accumulate(upper) - group * _HALF
        keep = np.append(same & (left[:-1] >= partner[1:]), False) | np.append(False, same & (upper[:-1] >= partner[1:]))
        if held is not None and given:
            keep[0] = False
        given = bool(keep[-1]) or (rows.shape[1] == 1 and held is not None and given)
        held, most = rows[:, -1:], int(upper[-1])
        yield _entries(rows[:, keep])


def _entries(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column) for column in rows], ["element", "name", "place"])


def _fitting(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j, which share an element, may be similar and are not yet joined."""
    n, d = THRESHOLD
    size, place = rows[2] % _HALF, rows[2] // _HALF
    left = np.minimum(size[i] - place[i], size[j] - place[j])
    balanced = np.minimum(size[i], size[j]) * d >= n * np.maximum(size[i], size[j])
    return balanced & (left >= overlap_needed(size[i], size[j])) & (rows[3][i] != rows[3][j])


def _candidates(rows: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs of names from different halves of the cells in `rows`, which are sorted and whole.

    Rows are element, name, place, component, low, high, part. A cell (low, high) holds the parts
    low and high of an element's sets; if they are one part, its sets are compared with each other.
    """
    at, apart = np.arange(rows.shape[1]), 1
    cell = np.cumsum(_cuts(rows))
    while len(at := at[at + apart < rows.shape[1]]) and len(at := at[cell[at] == cell[at + apart]]):
        across = (rows[4][at] == rows[5][at]) | (rows[6][at] != rows[6][at + apart])
        good = at[across & _fitting(rows, at, at + apart)]
        yield rows[1][np.stack([good, good + apart])]
        apart += 1


def _cuts(rows: np.ndarray) -> np.ndarray:
    """Whether a row begins a cell."""
    return np.any(np.diff(rows[[0, 4, 5]], axis=1, prepend=rows[[0, 4, 5], :1] - 1) != 0, axis=0)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows sorted by element, cell, size and name; a cell holds about 2 * `PART` sets."""
    held = np.empty((7, 0), np.int64)
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)])
        rows = np.concatenate([held, rows], axis=1)
        if not rows.shape[1]:
            continue
        done = int(np.flatnonzero(_cuts(rows))[-1])
        held = rows[:, done:]
        if done:
            yield from _batch(_candidates(rows[:, :done]))
    if held.shape[1]:
        yield from _batch(_candidates(held))


def _batch(parts) -> Iterator[pa.RecordBatch]:
    waiting, count = [], 0
    for part in parts:
        waiting.append(part)
        count += part.shape[1]
        if count > 50_000:
            yield _pair_rows(waiting)
            waiting, count = [], 0
    if waiting:
        yield _pair_rows(waiting)


def _pair_rows(parts: list[np.ndarray]) -> pa.RecordBatch:
    columns = np.unique(np.concatenate(parts, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pivot", "name"])


class Tree:
    """A prefix tree of sets in the global order, as their sorted rows and common beginnings."""

    def __init__(self, sets: list[np.ndarray], ranks: list[np.ndarray]):
        """`ranks` give each element's place in the global order among all elements of the tree."""
        self.order = sorted(range(len(sets)), key=lambda i: ranks[i].tolist())
        self.sets = [sets[i] for i in self.order]
        rows = [ranks[i] for i in self.order]
        self.shared = [0]
        for a, b in zip(rows, rows[1:], strict=False):
            both = min(len(a), len(b))
            different = np.flatnonzero(a[:both] != b[:both])
            self.shared.append(int(different[0]) if len(different) else both)

    def similar(self, pivot: np.ndarray) -> list[tuple[int, int]]:
        """Numbers and overlaps of the sets similar enough to `pivot` (ascending hashes).

        `common[k]` is the overlap of the first k elements of the current path; the next set keeps
        what it shares with it. A path ends where the lengths left cannot bring the overlap needed,
        and a set that goes on below that node is judged there by its own length.
        """
        found, common = [], np.zeros(1, np.int64)
        for number, own, shared in zip(self.order, self.sets, self.shared, strict=True):
            common = common[: shared + 1]
            needed = overlap_needed(len(pivot), len(own))
            at = len(common) - 1
            while at < len(own) and common[-1] + min(len(own) - at, len(pivot) - common[-1]) >= needed:
                step = own[at : at + 64]
                place = np.minimum(np.searchsorted(pivot, step), len(pivot) - 1)
                common = np.append(common, common[-1] + np.cumsum(pivot[place] == step))
                at += len(step)
            if at == len(own) and common[-1] >= needed:
                found.append((number, int(common[-1])))
        return found


def _verify(shared):
    """Links among rows (pivot, role, name, text) of a group: the pivot and its candidates."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        counts = shared.value
        pivot, names, sets = None, [], []
        for role, name, data in zip(group.column("role").to_pylist(), group.column("name").to_pylist(), byte_values(group.column("text").combine_chunks()), strict=True):
            own = shingles(data)
            if role == 0:
                pivot = own
            else:
                names.append(name)
                sets.append(ordered(own, counts))
        every = np.concatenate(sets)
        values, inverse = np.unique(every, return_inverse=True)
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, counts[(values % np.uint64(BUCKETS)).astype(np.int64)]))] = np.arange(len(values))
        ranks = np.split(rank[inverse], np.cumsum([len(s) for s in sets])[:-1])
        linked = [names[number] for number, _ in Tree(sets, ranks).similar(pivot)]
        return pa.table({"a": pa.array([key[0].as_py()] * len(linked), pa.int64()), "b": pa.array(linked, pa.int64())})

    return run


def _hooks(found: DataFrame) -> DataFrame:
    """`node`, `hook` for linked candidates: their smallest pivot, or that pivot's own smallest one.

    Equal hooks mean one component; different ones need not mean two, and are compared again.
    """
    up = stage(found.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("pivot")), "hooks")
    further = up.select(F.col("node").alias("pivot"), F.col("pivot").alias("beyond"))
    return up.join(further, "pivot", "left").select("node", F.coalesce("beyond", "pivot").alias("hook"))


def _with_pivots(rows: DataFrame, orders: tuple[int | None, ...], shift: float) -> DataFrame:
    """`pivot`, `name`: the sets of each element beside a few of them of about their size.

    A pivot comes first among the sets of an element and size band, in an order of all sets or by the
    element's place in the set. The sets in which shared elements come early hold little besides, so
    they are the middle of a group of copies: its elements agree on few pivots, and most of the group is
    similar to those. An element's rows move once, for all orders.
    """
    n, d = THRESHOLD
    logarithm = F.log(F.col("place") % F.lit(_HALF)) / F.lit(float(np.log(d / n)))
    rows = rows.withColumn("band", F.floor(logarithm + F.lit(shift)))
    group = Window.partitionBy("element", "band")
    own = F.struct("name", "place", "component")
    firsts = []
    for order, seed in enumerate(orders):
        place = F.floor(F.col("place") / _HALF) if seed is None else F.lit(0)
        first = F.min(F.struct(place.alias("at"), F.xxhash64("name", F.lit(seed or 0)).alias("rank"), own.alias("head"))).over(group)
        firsts.append(first.alias(f"first{order}"))
    heads = [F.struct(F.lit(order).alias("order"), F.col(f"first{order}.head").alias("head")) for order in range(len(orders))]
    both = rows.select("name", "place", "component", *firsts).select("name", "place", "component", F.explode(F.array(*heads)).alias("one"))
    both = both.select("name", "place", "component", "one.*")
    wanted = both.where(_may_link()).select("order", F.col("head.name").alias("pivot"), "name", F.ceil(_needed() / WITH_PIVOT).alias("needed"))
    shared = wanted.groupBy("order", "pivot", "name", "needed").agg(F.count(F.lit(1)).alias("shared"))
    return shared.where("shared >= needed").select("pivot", "name").distinct()


def _sizes():
    return F.col("place") % F.lit(_HALF), F.col("head.place") % F.lit(_HALF)


def _least_partner(size):
    """The smallest size of a set that is similar to one of `size`."""
    n, d = THRESHOLD
    return F.floor((n * size + (d - 1)) / d)


def _least_size(size: np.ndarray) -> np.ndarray:
    """`_least_partner` of numbers."""
    n, d = THRESHOLD
    return (n * size + (d - 1)) // d


def _may_link():
    """Whether a row and its `head` are not yet joined and share an element that counts for `_needed`."""
    n, d = THRESHOLD
    size, head = _sizes()
    left = F.least(size - F.floor(F.col("place") / _HALF), head - F.floor(F.col("head.place") / _HALF))
    balanced = F.least(size, head) * d >= n * F.greatest(size, head)
    return balanced & (left >= _least_partner(F.greatest(size, head))) & (F.col("component") != F.col("head.component"))


def _needed():
    """Elements that a row and its `head`, if similar, share in the beginnings that `_may_link` admits."""
    n, d = THRESHOLD
    size, head = _sizes()
    return F.floor((n * (size + head) + (n + d - 1)) / (n + d)) - _least_partner(F.greatest(size, head)) + 1


def _across(rows: DataFrame) -> DataFrame:
    """`pivot`, `name`: all sets of an element that are in different components and may be similar.

    The sets of an element are dealt over parts of about `PART`; each pair of parts is a cell of its own.
    """
    group = Window.partitionBy("element")
    rows = rows.select(
        "*",
        F.min("component").over(group).alias("least"),
        F.max("component").over(group).alias("most"),
        F.ceil(F.count(F.lit(1)).over(group) / PART).alias("parts"),
    ).where("least < most")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("name"), "parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    rows = rows.select("element", "name", "place", "component", "part", other).select(
        "element", "name", "place", "component", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part"
    )
    dealt = rows.repartition("element", "low", "high").sortWithinPartitions(
        "element", "low", "high", F.col("place") % F.lit(_HALF), "name"
    )
    return dealt.mapInArrow(_cells, "pivot long, name long").distinct()


def _folded(own: str, other: str):
    """The sketch `own` in the places of `other`, if that has half of them."""
    half = (F.size(own) / 2).cast("int")
    both = F.zip_with(F.slice(own, 1, half), F.slice(own, half + 1, half), lambda a, b: a.bitwiseXOR(b))
    return F.when(F.size(own) > F.size(other), both).otherwise(F.col(own))


def _not_apart(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sketches do not differ in more bits than similar sets of their sizes may differ in elements."""
    n, d = THRESHOLD
    one = texts.select(F.col("name").alias("pivot"), F.col("n_shingles").alias("size"), F.col("sketch").alias("mine"))
    both = pairs.join(one, "pivot").join(texts.select("name", "n_shingles", "sketch"), "name")
    bits = F.zip_with(_folded("mine", "sketch"), _folded("sketch", "mine"), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    apart = F.aggregate(bits, F.lit(0), lambda sum_, next_: sum_ + next_)  # null, if sizes are too different to say
    sizes = F.col("size") + F.col("n_shingles")
    return both.where(F.coalesce(apart, F.lit(0)) <= sizes - 2 * F.floor((n * sizes + (n + d - 1)) / (n + d))).select("pivot", "name")


def links(entries: DataFrame, texts: DataFrame, shared) -> DataFrame:
    """Links `a`, `b` between set names that join all similar sets into the right components."""
    found = None
    for number, pivots in enumerate((*PIVOTS, None)):
        if found is None:
            rows = entries.withColumn("component", F.col("name"))
        else:
            joined = _hooks(found) if number == 1 else components(found).withColumnRenamed("component", "hook")
            rows = entries.join(joined, F.col("name") == F.col("node"), "left").select(
                *entries.columns, F.coalesce("hook", "name").alias("component")
            )
        pairs = stage(_not_apart(_across(rows) if pivots is None else _with_pivots(rows, *pivots), texts), "candidate-pairs")
        trees = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / TREE).alias("trees"))
        members = pairs.join(trees, "pivot").select("pivot", F.pmod(F.xxhash64("name"), "trees").alias("tree"), F.lit(1).alias("role"), "name")
        heads = members.select("pivot", "tree", F.lit(0).alias("role"), F.col("pivot").alias("name")).distinct()
        wanted = pairs.select(F.explode(F.array("pivot", "name")).alias("name")).distinct().select(F.xxhash64("name").alias("hash"))
        read = within(texts.select("name", "text"), F.xxhash64("name"), bitmap_of(wanted, "hash"))
        checked = (
            members.union(heads)
            .join(read, "name")
            .groupBy("pivot", "tree")
            .applyInArrow(_verify(shared), "a long, b long")
        )
        checked = stage(checked, "links")
        found = checked if found is None else found.union(checked)
    return found


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_shingles`, `component_id`, `version` (a hash of the text) of every row of `docs`.

    A set holds the distinct 5-word shingles of a text, or with fewer words their whole sequence.
    Null, empty and blank texts have the empty set and are linked with nothing: their component is
    their own key. Rows with a null key take no part and have a null component. Repeated rows come
    back as often. Other columns are ignored; an empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    both = stage(source.withColumn("version", F.xxhash64("text")).mapInArrow(_names, _NAMED), "set-names")
    named = both.where("slice is null").drop("slice", "counts", "sketch")
    counts = document_counts(both)
    shared = spark.sparkContext.broadcast(counts)  # 4 * BUCKETS bytes
    with_key = source.where(F.col("doc").isNotNull() & F.col("text").isNotNull())
    entries = stage(
        with_key.select("text")
        .mapInArrow(_prefixes(shared), _ENTRY)
        .repartition("element")
        .sortWithinPartitions("element", F.col("place") % F.lit(_HALF), "name")
        .mapInArrow(_sharing, _ENTRY),
        "shared-prefixes",
    )
    sets = both.where("doc is not null and name is not null")
    classes = sets.groupBy("name").agg(F.min("doc").alias("first"))
    one = F.min(F.struct("doc", "version", "n_shingles", "sketch")).alias("one")
    involved = stage(
        sets.join(entries.select("name").distinct(), "name", "left_semi").groupBy("name").agg(one).select("name", "one.*"), "involved-sets"
    )
    # A key may come with several texts, and a row repeatedly; copies are united before and after they move.
    own = with_key.withColumn("version", F.xxhash64("text"))
    own = within(own, F.xxhash64("doc", "version"), bitmap_of(involved.select(F.xxhash64("doc", "version").alias("hash")), "hash"))
    texts = own.join(involved, ["doc", "version"]).dropDuplicates(["doc", "version"])
    joined = components(links(entries, stage(texts.select("name", "n_shingles", "sketch", "text"), "texts"), shared))
    # A component is named after the smallest document of its sets.
    labels = classes.join(joined, F.col("name") == F.col("node"), "left").select(
        "name", F.coalesce("component", "name").alias("component"), "first"
    )
    smallest = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    by_name = labels.join(smallest, "component").select(F.col("name").alias("set"), "component_id")
    kind = docs.schema[key].dataType
    return named.join(by_name, F.col("name") == F.col("set"), "left").select(
        F.col("doc").cast(kind).alias(key),
        "n_shingles",
        F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc")).cast(kind).alias("component_id"),
        "version",
    )
