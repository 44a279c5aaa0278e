"""Query catalogue: change detection between key-less releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions.fingerprint import row_fingerprint, row_text
from civiclake.operators import revisions as R
from civiclake.operators.ranking import top_per_group
from civiclake.plans import views as V

ROW = V.COMPARED


def _ab(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return V.rel(spark, folder, "a"), V.rel(spark, folder, "b")


def multiset_diff(spark: SparkSession, folder: str) -> DataFrame:
    a, b = _ab(spark, folder)
    diff = R.multiset_diff(a, b, ROW, carry=["sk"])
    return diff.groupBy("sk").agg(
        F.sum("entered").alias("entered"), F.sum("left").alias("left"), F.sum("same").alias("same")
    )


def multiset_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = R.multiset_counts(V.rel(spark, folder, "a"), ROW, carry=["fl"])
    return counts.groupBy("fl", "n").agg(F.count("*").alias("distinct_rows"))


def changed_rows(spark: SparkSession, folder: str) -> DataFrame:
    a, b = _ab(spark, folder)
    changes = R.stage(R.weighted_changes(a, b, ROW, entity=["sk"]), "changes")
    parts = [
        R.repeat_rows(changes.select(*ROW, F.col(side).alias("_times")), "_times").withColumn(
            "side", F.lit(side)
        )
        for side in ("left", "entered")
    ]
    return parts[0].unionByName(parts[1])


def multiset_proof(spark: SparkSession, folder: str) -> DataFrame:
    a, b = _ab(spark, folder)
    return R.multiset_proof(a, b, ROW, ["ls"])


def entity_revision_rollup(spark: SparkSession, folder: str) -> DataFrame:
    a, b = _ab(spark, folder)
    diff = R.multiset_diff(a, b, ROW, by=["yr"], carry=["sk"])
    return R.entity_rollup(diff, ["yr", "sk"])


def revision_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per year, and how many entities moved at all."""
    a, b = _ab(spark, folder)
    diff = R.multiset_diff(a, b, ROW, by=["yr"], carry=["sk"])
    per_entity = R.entity_rollup(diff, ["yr", "sk"])
    return per_entity.groupBy("yr").agg(
        F.count("*").alias("entities"),
        F.count_if(F.col("entered") + F.col("left") > 0).alias("entities_changed"),
        F.sum("before").alias("before"),
        F.sum("after").alias("after"),
        F.sum(F.col("before") - F.col("left")).alias("same"),
        F.sum("entered").alias("entered"),
        F.sum("left").alias("left"),
    )


def all_pairs_diff(spark: SparkSession, folder: str) -> DataFrame:
    names = ("a", "b", "c")
    tagged = R.tag_releases({n: V.rel(spark, folder, n) for n in names}, ["yr", *ROW])
    return R.all_pairs(R.tally(tagged, names, ROW, by=["yr"]), names, ["yr"])


def field_attribution(spark: SparkSession, folder: str) -> DataFrame:
    a, b = _ab(spark, folder)
    return R.attribute_fields(R.weighted_changes(a, b, ROW, entity=["sk"]), ROW)


def row_fingerprint_query(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct rows by fingerprint and by row text, on a release with NULLs."""
    rows = V.rel(spark, folder, "c")
    per_print = rows.select(*row_fingerprint(ROW), "ls").groupBy("h1", "h2", "ls").count()
    per_text = rows.select(row_text(ROW).alias("t"), "ls").groupBy("t", "ls").count()
    counted = [
        df.groupBy("ls").agg(F.count("*").alias("n"), F.sum("count").alias("total"))
        for df in (per_print, per_text)
    ]
    left, right = counted[0], counted[1].withColumnsRenamed({"n": "n_text", "total": "t"})
    return left.join(right, "ls").select(
        "ls",
        F.col("n").alias("distinct_fingerprints"),
        F.col("n_text").alias("distinct_texts"),
        F.col("total").alias("n_rows"),
    )


def except_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Differences seen when the publisher-computed column is left out of the comparison."""
    a, b = _ab(spark, folder)
    kept = [c for c in a.columns if c not in ("yr", "fl")]
    return R.pair_summary(R.multiset_diff(a, b, kept))


def multiset_take(spark: SparkSession, folder: str) -> DataFrame:
    taken = R.multiset_take(V.rel(spark, folder, "a"), ROW, 2)
    return taken.groupBy("sk", "fl").agg(F.count("*").alias("n"), F.sum("q").alias("sum_q"))


def topk_per_group(spark: SparkSession, folder: str) -> DataFrame:
    a, b = _ab(spark, folder)
    per_entity = R.entity_rollup(R.multiset_diff(a, b, ROW, by=["yr"], carry=["sk"]), ["yr", "sk"])
    moved = per_entity.withColumn("moved", F.col("entered") + F.col("left"))
    ranked = top_per_group(moved, ["yr"], [F.desc("moved"), F.asc("sk")], 12)
    return ranked.select("yr", "sk", "entered", "left", "moved", F.col("rank").cast("long"))


QUERIES = {
    "multiset_diff": multiset_diff,
    "multiset_counts": multiset_counts,
    "changed_rows": changed_rows,
    "multiset_proof": multiset_proof,
    "entity_revision_rollup": entity_revision_rollup,
    "revision_summary": revision_summary,
    "all_pairs_diff": all_pairs_diff,
    "field_attribution": field_attribution,
    "row_fingerprint": row_fingerprint_query,
    "except_columns": except_columns,
    "multiset_take": multiset_take,
    "topk_per_group": topk_per_group,
}

_COLS = "sk, q, fl, ls, dc"
_BAGS = (
    f"l AS (SELECT {_COLS} FROM rel_a EXCEPT ALL SELECT {_COLS} FROM rel_b), "
    f"e AS (SELECT {_COLS} FROM rel_b EXCEPT ALL SELECT {_COLS} FROM rel_a)"
)
_YBAGS = (
    f"l AS (SELECT yr, {_COLS} FROM rel_a EXCEPT ALL SELECT yr, {_COLS} FROM rel_b), "
    f"e AS (SELECT yr, {_COLS} FROM rel_b EXCEPT ALL SELECT yr, {_COLS} FROM rel_a)"
)
_PER_ENTITY = (
    f"{_YBAGS}, m AS ("
    "SELECT yr, sk, 1 AS b, 0 AS a, 0 AS e, 0 AS l FROM rel_a UNION ALL "
    "SELECT yr, sk, 0, 1, 0, 0 FROM rel_b UNION ALL "
    "SELECT yr, sk, 0, 0, 1, 0 FROM e UNION ALL SELECT yr, sk, 0, 0, 0, 1 FROM l), "
    "ent AS (SELECT yr, sk, cast(sum(b) as bigint) AS before, cast(sum(a) as bigint) AS after, "
    "cast(sum(e) as bigint) AS entered, cast(sum(l) as bigint) AS left_ FROM m GROUP BY yr, sk)"
)


def _pairs_sql(field: str) -> str:
    rest = ", ".join(c for c in ROW if c != field)
    return (
        f"SELECT '{field}' AS field, cast(sum(least(nl, ne)) as bigint) AS pairs FROM ("
        f"SELECT {rest}, count(*) FILTER (side = 'l') AS nl, count(*) FILTER (side = 'e') AS ne "
        f"FROM both_sides GROUP BY {rest})"
    )


def _pair_sql(a: str, b: str) -> str:
    cols = f"yr, {_COLS}"
    return (
        f"SELECT yr, '{a}' AS from_release, '{b}' AS to_release, "
        "cast(sum(b) as bigint) AS before, cast(sum(a) as bigint) AS after, "
        "cast(sum(b) - sum(l) as bigint) AS same, "
        'cast(sum(e) as bigint) AS entered, cast(sum(l) as bigint) AS "left" FROM ('
        f"SELECT yr, 1 AS b, 0 AS a, 0 AS e, 0 AS l FROM rel_{a} UNION ALL "
        f"SELECT yr, 0, 1, 0, 0 FROM rel_{b} UNION ALL "
        f"SELECT yr, 0, 0, 1, 0 FROM (SELECT {cols} FROM rel_{b} EXCEPT ALL SELECT {cols} FROM rel_{a}) UNION ALL "
        f"SELECT yr, 0, 0, 0, 1 FROM (SELECT {cols} FROM rel_{a} EXCEPT ALL SELECT {cols} FROM rel_{b})) "
        "GROUP BY yr"
    )


ORACLE = {
    "multiset_diff": f"WITH {_BAGS}, na AS (SELECT sk, count(*) n FROM rel_a GROUP BY sk), "
    "nl AS (SELECT sk, count(*) n FROM l GROUP BY sk), ne AS (SELECT sk, count(*) n FROM e GROUP BY sk) "
    'SELECT coalesce(na.sk, ne.sk) AS sk, coalesce(ne.n, 0) AS entered, coalesce(nl.n, 0) AS "left", '
    "coalesce(na.n, 0) - coalesce(nl.n, 0) AS same FROM na FULL JOIN ne ON na.sk = ne.sk "
    "LEFT JOIN nl ON nl.sk = na.sk",
    "multiset_counts": "SELECT fl, n, count(*) AS distinct_rows FROM ("
    f"SELECT {_COLS}, count(*) AS n FROM rel_a GROUP BY {_COLS}) GROUP BY fl, n",
    "changed_rows": f"WITH {_BAGS} SELECT {_COLS}, 'left' AS side FROM l UNION ALL "
    f"SELECT {_COLS}, 'entered' AS side FROM e",
    "multiset_proof": f"WITH {_BAGS}, s AS (SELECT ls FROM rel_a UNION SELECT ls FROM rel_b) "
    "SELECT ls, nl AS exact_left, ne AS exact_entered, nl AS hash_left, ne AS hash_entered, true AS agrees FROM ("
    "SELECT s.ls, (SELECT count(*) FROM l WHERE l.ls = s.ls) AS nl, "
    "(SELECT count(*) FROM e WHERE e.ls = s.ls) AS ne FROM s)",
    "entity_revision_rollup": f"WITH {_PER_ENTITY} "
    'SELECT yr, sk, before, after, entered, left_ AS "left" FROM ent',
    "revision_summary": f"WITH {_PER_ENTITY} SELECT yr, count(*) AS entities, "
    "count(*) FILTER (entered + left_ > 0) AS entities_changed, "
    "cast(sum(before) as bigint) AS before, cast(sum(after) as bigint) AS after, "
    "cast(sum(before - left_) as bigint) AS same, cast(sum(entered) as bigint) AS entered, "
    'cast(sum(left_) as bigint) AS "left" FROM ent GROUP BY yr',
    "all_pairs_diff": " UNION ALL ".join(_pair_sql(a, b) for a, b in ("ab", "ac", "bc")),
    "field_attribution": f"WITH {_BAGS}, both_sides AS (SELECT *, 'l' AS side FROM l UNION ALL "
    "SELECT *, 'e' AS side FROM e), p AS ("
    + " UNION ALL ".join(_pairs_sql(f) for f in ROW)
    + ") SELECT field, pairs FROM p WHERE pairs > 0",
    "row_fingerprint": "SELECT ls, count(*) AS distinct_fingerprints, count(*) AS distinct_texts, "
    "cast(sum(n) as bigint) AS n_rows FROM "
    f"(SELECT {_COLS}, count(*) AS n FROM rel_c GROUP BY {_COLS}) GROUP BY ls",
    "except_columns": "WITH l AS (SELECT sk, q, ls, dc FROM rel_a EXCEPT ALL SELECT sk, q, ls, dc FROM rel_b), "
    "e AS (SELECT sk, q, ls, dc FROM rel_b EXCEPT ALL SELECT sk, q, ls, dc FROM rel_a) "
    "SELECT (SELECT count(*) FROM rel_a) AS before, (SELECT count(*) FROM rel_b) AS after, "
    "(SELECT count(*) FROM rel_a) - (SELECT count(*) FROM l) AS same, "
    '(SELECT count(*) FROM e) AS entered, (SELECT count(*) FROM l) AS "left"',
    "multiset_take": "SELECT sk, fl, count(*) AS n, cast(sum(q) as bigint) AS sum_q FROM ("
    f"SELECT {_COLS}, row_number() OVER (PARTITION BY {_COLS}) AS i FROM rel_a) WHERE i <= 2 GROUP BY sk, fl",
    "topk_per_group": f"WITH {_PER_ENTITY} "
    'SELECT yr, sk, entered, left_ AS "left", entered + left_ AS moved, '
    "row_number() OVER (PARTITION BY yr ORDER BY entered + left_ DESC, sk) AS rank "
    "FROM ent QUALIFY rank <= 12",
}
