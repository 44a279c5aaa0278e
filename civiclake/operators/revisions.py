"""Change detection between releases of a register that has no record key.

Two releases are compared as multisets of rows. Everything below starts from one tally: rows
of all releases are tagged, and one aggregation counts each distinct row per release. Map-side
combining makes heavily repeated rows cheap, and nothing is joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.fingerprint import field_hash, row_fingerprint
from civiclake.operators.digests import bitmap_of, changed_prints, release_prints, within
from civiclake.sources.scratch import stage

#: Columns that are looked at one by one instead of being halved again.
HALVED_TO = 8
#: Copies one generated row may stand for before the copies are spread over the cluster.
COPIES_PER_ROW = 10_000

_KEYS = ("h1", "h2")


def tag_releases(releases: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """One table of all releases with a `release` column."""
    tagged = [df.select(*columns, F.lit(name).alias("release")) for name, df in releases.items()]
    return reduce(DataFrame.unionByName, tagged)


def multiset_counts(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), carry: Sequence[str] = ()
) -> DataFrame:
    """Fingerprint and number of copies of each distinct row.

    `carry` must be among `columns`: equal rows have equal attributes, so they can travel in
    the grouping key. That keeps the hash aggregate; first() on text would need a sort.
    """
    kept = list(dict.fromkeys([*by, *carry]))
    return (
        df.select(*row_fingerprint(columns), *kept)
        .groupBy(*_KEYS, *kept)
        .agg(F.count("*").alias("n"))
    )


def tally(
    tagged: DataFrame,
    names: Sequence[str],
    columns: Sequence[str],
    by: Sequence[str] = (),
    carry: Sequence[str] = (),
    whole_rows: bool = False,
) -> DataFrame:
    """Copies of each distinct row per release, as columns `n_<release>`.

    With `whole_rows` the rows themselves are the key (exact, wide shuffle); otherwise the
    128-bit fingerprint plus the carried attributes.
    """
    counts = [F.count_if(F.col("release") == name).alias(f"n_{name}") for name in names]
    if whole_rows:
        keys = list(dict.fromkeys([*by, *columns]))
        return tagged.groupBy(*keys).agg(*counts)
    kept = list(dict.fromkeys([*by, *carry]))
    return (
        tagged.select(*row_fingerprint(columns), *kept, "release")
        .groupBy(*_KEYS, *kept)
        .agg(*counts)
    )


def _difference(before: Column, after: Column) -> list[Column]:
    nothing = F.lit(0).cast("long")
    return [
        F.greatest(after - before, nothing).alias("entered"),
        F.greatest(before - after, nothing).alias("left"),
        F.least(before, after).alias("same"),
    ]


def multiset_diff(
    before: DataFrame,
    after: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    carry: Sequence[str] = (),
    whole_rows: bool = False,
) -> DataFrame:
    """Per distinct row: copies before and after, and how many entered, left, stayed.

    One shuffle of 16 bytes plus the carried attributes per distinct row and task.
    """
    needed = list(dict.fromkeys([*by, *columns]))
    tagged = tag_releases({"before": before, "after": after}, needed)
    counted = tally(tagged, ("before", "after"), columns, by, carry, whole_rows)
    return counted.select("*", *_difference(F.col("n_before"), F.col("n_after")))


def pair_of(counted: DataFrame, before: str, after: str) -> DataFrame:
    """The difference of two of the releases of a tally, in the columns of `multiset_diff`."""
    kept = [c for c in counted.columns if not c.startswith("n_")]
    two = counted.select(*kept, F.col(f"n_{before}").alias("n_before"), F.col(f"n_{after}").alias("n_after"))
    return two.where("n_before + n_after > 0").select("*", *_difference(F.col("n_before"), F.col("n_after")))


def changed_only(diff: DataFrame) -> DataFrame:
    return diff.where((F.col("entered") > 0) | (F.col("left") > 0))


def weighted_changes(
    before: DataFrame,
    after: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    diff: DataFrame | None = None,
    entity: Sequence[str] = (),
) -> DataFrame:
    """Each distinct changed row once, with its weights `entered` and `left`.

    The difference is found on fingerprints (or given as `diff`, of the same rows), and picks the full
    rows. Entities and ranges of fingerprints with equal digests are left out before anything is
    counted row by row. Full rows are read through a bitmap of the changed fingerprints, whose size
    does not depend on their number; those it lets through lose their copies before they move,
    so neither many changed rows nor many copies of one meet in a task.
    """
    kept = list(dict.fromkeys([*by, *columns]))
    if diff is None:
        prints = changed_prints(*(release_prints(df, columns, by, entity) for df in (before, after)))
        counted = prints.groupBy(*_KEYS, *by).agg(F.sum("weight").alias("net")).where("net <> 0")
        nothing = F.lit(0).cast("long")
        diff = counted.select(*_KEYS, *by, F.greatest("net", nothing).alias("entered"), F.greatest(-F.col("net"), nothing).alias("left"))
    keys = changed_only(diff).select(*[F.col(c).alias(f"_k_{c}") for c in (*_KEYS, *by)], "entered", "left")
    keys = stage(keys, "changed-keys")
    rows = before.select(*kept).unionByName(after.select(*kept)).select(*kept, *row_fingerprint(columns))
    candidates = within(rows, F.col("h1"), bitmap_of(keys, "_k_h1")).distinct()
    # The staged keys get their own names, so both sides can be spoken of by name.
    same_row = reduce(
        lambda a, b: a & b,
        [F.col(c) == F.col(f"_k_{c}") for c in _KEYS] + [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by],
    )
    return candidates.join(keys, same_row).select(*kept, "entered", "left")


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row `times` times, without building long arrays or long tasks.

    Rows with few copies expand in place. A row with many is first cut into chunks, the
    chunks are spread over the cluster, and each expands where it lands.
    """
    kept = [c for c in df.columns if c != times]
    n = F.col(times)
    few = df.where((n > 0) & (n <= COPIES_PER_ROW))
    in_place = few.select(*kept, F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("_copy"))
    chunks = F.sequence(F.lit(0), F.ceil(n / COPIES_PER_ROW).cast("int") - 1)
    many = (
        df.where(n > COPIES_PER_ROW)
        .select(*kept, n.alias("_n"), F.explode(chunks).alias("_chunk"))
        .select(
            *kept,
            "_chunk",
            F.least(
                F.lit(COPIES_PER_ROW).cast("long"),
                F.col("_n") - F.col("_chunk").cast("long") * COPIES_PER_ROW,
            ).alias("_part"),
        )
        .repartition(F.xxhash64("_chunk", *kept))
    )
    spread = many.select(
        *kept, F.explode(F.sequence(F.lit(1), F.col("_part").cast("int"))).alias("_copy")
    )
    return in_place.select(*kept).unionByName(spread.select(*kept))


def changed_rows(
    before: DataFrame, after: DataFrame, columns: Sequence[str], side: str, entity: Sequence[str] = ()
) -> DataFrame:
    """The rows that left (`side='left'`) or entered, with multiplicity, as a bag difference."""
    if side not in ("left", "entered"):
        raise ValueError(f"side must be 'left' or 'entered', not {side!r}")
    changes = weighted_changes(before, after, columns, entity=entity)
    return repeat_rows(changes.select(*columns, F.col(side).alias("_times")), "_times")


def multiset_take(df: DataFrame, columns: Sequence[str], copies: int) -> DataFrame:
    """At most `copies` copies of each distinct row, chosen among identical rows."""
    counted = df.groupBy(*columns).agg(
        F.least(F.count("*"), F.lit(copies).cast("long")).alias("_times")
    )
    return repeat_rows(counted, "_times")


def _xor(values: Column, start: Column) -> Column:
    return F.aggregate(values, start, lambda a, x: a.bitwiseXOR(x))


def attribute_fields(
    changes: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Pairs per field: rows that left and rows that entered which differ only in that field.

    `changes` are weighted distinct rows (see `weighted_changes`), so copies are never
    expanded. Each field has a positional hash; the row without some fields is the XOR of all
    of them XOR theirs. Two 64-bit hashes make accidental equality negligible. There is no
    partitioning by any compared field: a correction of that very field would be lost.

    Rows that differ in one field agree in all fields outside the half it lies in. So the columns are halved:
    a row stays for a half only if a row of the other side agrees with it outside, and only what stays is
    halved again. Most rows agree with none, and few are ever looked at field by field.
    """
    hashes = {seed: F.array(*[field_hash(i, c, seed) for i, c in enumerate(columns)]) for seed in (1, 2)}
    rows = changes.select(*by, "entered", "left", hashes[1].alias("_f1"), hashes[2].alias("_f2"))
    size = len(columns)
    if size > HALVED_TO:
        rows = stage(rows, "change-hashes")  # read once for each level
    zero = F.lit(0).cast("long")
    rows = rows.select("*", _xor(F.col("_f1"), zero).alias("_t1"), _xor(F.col("_f2"), zero).alias("_t2"), F.lit(0).alias("_lo"), F.lit(size).alias("_hi"))
    kept, part = rows.columns[:-2], [*by, "_lo", "_hi", "_k1", "_k2"]
    while size > HALVED_TO:
        middle = F.floor((F.col("_lo") + F.col("_hi")) / 2).cast("int")
        halves = F.array(F.struct(F.col("_lo").alias("_lo"), middle.alias("_hi")), F.struct(middle.alias("_lo"), F.col("_hi").alias("_hi")))
        rows = rows.select(*kept, F.inline(halves)).select(
            "*", *[_xor(F.slice(f"_f{i}", F.col("_lo") + 1, F.col("_hi") - F.col("_lo")), F.col(f"_t{i}")).alias(f"_k{i}") for i in (1, 2)]
        )
        met = rows.groupBy(*part).agg(F.sum("entered").alias("entered"), F.sum("left").alias("left")).where("entered > 0 AND `left` > 0")
        known = F.xxhash64(*[x for c in part for x in (F.isnull(c), F.col(c))])
        met = stage(met.select(known.alias("part")), "agreeing-halves")
        rows = within(rows, known, bitmap_of(met, "part")).drop("_k1", "_k2")
        size = -(-size // 2)
    fields = rows.select(*by, "entered", "left", "_t1", "_t2", "_f1", "_f2", F.explode(F.sequence("_lo", F.col("_hi") - 1)).alias("_i"))
    keys = [F.col(f"_t{i}").bitwiseXOR(F.get(f"_f{i}", F.col("_i"))).alias(f"_k{i}") for i in (1, 2)]
    return (
        fields.select(*by, "entered", "left", "_i", *keys)
        .groupBy(*by, "_i", "_k1", "_k2")
        .agg(F.sum("entered").alias("entered"), F.sum("left").alias("left"))
        .groupBy(*by, "_i")
        .agg(F.sum(F.least("entered", "left")).alias("pairs"))
        .where(F.col("pairs") > 0)
        .select(*by, F.get(F.array(*map(F.lit, columns)), F.col("_i")).alias("field"), "pairs")
    )


def entity_rollup(diff: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Rows before, after, entered and left per entity, from the difference in one pass."""
    return diff.groupBy(*entity).agg(
        F.sum("n_before").alias("before"),
        F.sum("n_after").alias("after"),
        F.sum("entered").alias("entered"),
        F.sum("left").alias("left"),
    )


def pair_summary(diff: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows before and after, unchanged, entered and left."""
    sums = [
        F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(name)
        for c, name in (
            ("n_before", "before"),
            ("n_after", "after"),
            ("same", "same"),
            ("entered", "entered"),
            ("left", "left"),
        )
    ]
    return diff.groupBy(*by).agg(*sums) if by else diff.agg(*sums)


def all_pairs(counted: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Summary of every (earlier, later) pair of releases from one tally.

    `names` in order of maturity. All pairs share one shuffle instead of one comparison each.
    """
    pairs = [
        F.struct(
            F.lit(a).alias("from_release"),
            F.lit(b).alias("to_release"),
            F.col(f"n_{a}").alias("n_before"),
            F.col(f"n_{b}").alias("n_after"),
            *_difference(F.col(f"n_{a}"), F.col(f"n_{b}")),
        )
        for a, b in combinations(names, 2)
    ]
    return pair_summary(
        counted.select(*by, F.inline(F.array(*pairs))), [*by, "from_release", "to_release"]
    )


def multiset_proof(
    before: DataFrame, after: DataFrame, columns: Sequence[str], slices: Sequence[str], diff: DataFrame | None = None
) -> DataFrame:
    """Exact bag difference next to the fingerprint result (or `diff`, of the same rows), per slice.

    Whole rows are the key of one tally, without any hash of ours: what `exceptAll` of either side counts, both
    directions from one scan of each release. `agrees` must be true.
    """
    whole = multiset_diff(before, after, columns, whole_rows=True)
    exact = whole.groupBy(*slices).agg(F.sum("left").alias("left"), F.sum("entered").alias("entered")).where("`left` > 0 OR entered > 0")
    hashed = entity_rollup(multiset_diff(before, after, columns, carry=slices) if diff is None else diff, slices)
    both = [
        sums.select(*slices, F.inline(F.array(*[F.struct(F.lit(f"{way}_{side}").alias("what"), F.col(side).alias("n")) for side in ("left", "entered")])))
        for way, sums in (("exact", exact), ("hash", hashed))
    ]
    names = ("exact_left", "exact_entered", "hash_left", "hash_entered")
    together = reduce(DataFrame.unionByName, both)
    sums = together.groupBy(*slices).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("what") == n, F.col("n"))), F.lit(0).cast("long")).alias(n)
            for n in names
        ]
    )
    agrees = (F.col("exact_left") == F.col("hash_left")) & (
        F.col("exact_entered") == F.col("hash_entered")
    )
    return sums.withColumn("agrees", agrees)
