"""Query catalogue: releases, manifests, precedence, ranking."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators import ranking as K
from civiclake.operators import releases as R
from civiclake.operators.asof import as_of_join
from civiclake.plans import views as V
from civiclake.sources import dimensions as D
from civiclake.sources import inventory as I
from civiclake.sources.publishing import append_log, publish_all, read_current
from civiclake.sources.scratch import new_dir, stage

DAYS = (date(1997, 6, 1), date(2000, 1, 1), date(2003, 6, 30))


def current_release(spark: SparkSession, folder: str) -> DataFrame:
    table, registry = V.released_apps(spark, folder), V.registry(spark, folder)
    return R.current(table, registry, "yr").groupBy("yr", "release").agg(
        F.count("*").alias("n"), F.count_if(F.col("outcome") == 3).alias("denied")
    )


def _effective(registry: DataFrame) -> DataFrame:
    """The registrations that changed what a reader saw, in the order they did."""
    return R.publication_order(registry, "yr").where("takes_effect")


def as_of_date(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and denials an analyst saw on each of three days, from published partitions.

    Only the partitions that were visible on some day are opened.
    """
    root = new_dir(spark, "stored-releases")
    rows = V.released_apps(spark, folder)
    publish_all(rows, root, "yr", "release")
    registry = V.registry(spark, folder)
    days = F.explode(F.array(*[F.lit(d) for d in DAYS])).alias("as_of")
    asked = registry.select("yr").distinct().select("yr", days)
    visible = as_of_join(asked, _effective(registry), ["yr"], "as_of", "frozen_at", ["maturity", "release"])
    visible = stage(visible.where("release IS NOT NULL").select("as_of", "yr", "release"), "visible")
    stored = R.read_releases(read_current(spark, root, rows.schema), visible, "yr")
    cells = stored.groupBy("yr", "release").agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == 3).alias("denied"))
    return visible.join(cells, ["yr", "release"])


def as_of_rows(spark: SparkSession, folder: str) -> DataFrame:
    """For every order, which release of its year was in force when it was looked up, some days after it was made."""
    orders = V.table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("yr"), F.expr("cast(date_add(o_orderdate, cast(o_orderkey % 1500 as int)) as date)").alias("day"), "o_totalprice"
    )
    seen = as_of_join(orders, _effective(V.registry(spark, folder)), ["yr"], "day", "frozen_at", ["maturity", "release"])
    return seen.groupBy("yr", "release").agg(F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def publication_order(spark: SparkSession, folder: str) -> DataFrame:
    ordered = R.publication_order(V.registry(spark, folder), "yr")
    return ordered.select(
        "yr", "release", "frozen_at", F.col("position").cast("bigint").alias("position"), "takes_effect"
    )


def release_scope(spark: SparkSession, folder: str) -> DataFrame:
    return R.scope(V.registry(spark, folder), "yr", (1997, 1998)).select("yr", "release", "maturity")


def release_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Registry kept as a log: a forced second application of some releases counts once."""
    log = new_dir(spark, "registry-log")
    rows = V.registry(spark, folder)
    first = rows.withColumn("applied_at", F.date_add("frozen_at", 1))
    again = rows.where("release = 'first'").select(
        "yr", "release", "maturity", "frozen_at", (F.col("n_rows") + 1).alias("n_rows"),
        F.date_add("frozen_at", 30).alias("applied_at"),
    )
    append_log(first, log)
    append_log(again, log)
    stored = spark.read.schema(first.schema).parquet(log)
    return R.latest_registration(stored, "yr").select("yr", "release", "frozen_at", "n_rows", "applied_at")


def release_delta(spark: SparkSession, folder: str) -> DataFrame:
    delta = R.release_delta(V.registry(spark, folder), "yr", "n_rows")
    return delta.select("yr", "release", "n_rows", "added")


# --- manifests and listings built from the documents ---------------------------------------

_HISTORY = {
    "source": "source",
    "part": "doc_id % 50",
    "doc": "doc_id",
    "at": "doc_id - doc_id % 2",
    "etag": "md5(text)",
    "bytes": "n_chars",
}
_LISTING = {
    "source": "source",
    "part": "doc_id % 50",
    "etag": "case when doc_id % 7 = 0 then md5(concat(text, 'x')) else md5(text) end",
    "bytes": "case when doc_id % 11 = 0 then n_chars + 1 else n_chars end",
    "error": "case when doc_id % 29 = 0 then 'timeout' end",
    "doc": "doc_id",
}


def _history(spark: SparkSession, folder: str) -> DataFrame:
    docs = V.table(spark, folder, "documents").where("doc_id % 13 <> 0")
    return docs.select(*[F.expr(sql).alias(n) for n, sql in _HISTORY.items()])


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    docs = V.table(spark, folder, "documents")
    listed = docs.select(*[F.expr(sql).alias(n) for n, sql in _LISTING.items()])
    return K.latest_per_key(listed, ["source", "part"], [F.desc("doc")])


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    history = _history(spark, folder)
    return K.latest_per_key(history, ["source", "part"], [F.desc("doc")])


def latest_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return I.latest_manifest(_history(spark, folder), ["source", "part"], "doc").select(
        "source", "part", "doc", "etag", "bytes"
    )


def source_inventory_diff(spark: SparkSession, folder: str) -> DataFrame:
    listing = _listing(spark, folder).where("part % 17 <> 3")
    return I.inventory_diff(_manifest(spark, folder), listing, ["source", "part"])


def source_decision(spark: SparkSession, folder: str) -> DataFrame:
    return I.decision(source_inventory_diff(spark, folder))


def pending_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Listed sources whose content is not the one last loaded."""
    candidates = _listing(spark, folder)
    return I.pending_loads(candidates, _history(spark, folder), ["source", "part"], "etag", "doc").select(
        "source", "part", "doc", "etag"
    )


def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = V.table(spark, folder, "events")
    latest = K.latest_per_key(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])
    return latest.select("user_id", "event_type", "event_id", "value")


def dimension_precedence(spark: SparkSession, folder: str) -> DataFrame:
    """Names from two vintages, the earlier one wins; a missing name falls back to the key."""
    customers = V.table(spark, folder, "customer")
    older = customers.where("c_custkey % 3 <> 0").select("c_custkey", F.col("c_name").alias("name"))
    newer = customers.where("c_custkey % 5 <> 0").select("c_custkey", F.upper("c_name").alias("name"))
    names = D.with_precedence([older, newer], ["c_custkey"])
    orders = V.table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    counted = orders.groupBy("c_custkey").agg(F.count("*").alias("n"))
    return D.lookup(counted, names, ["c_custkey"], "name", F.col("c_custkey").cast("string"))


def topk_global(spark: SparkSession, folder: str) -> DataFrame:
    counts = V.apps(spark, folder).groupBy("entity").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "entity").limit(12)


def topk_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Districts with at least 20 rows, by volume, in the latest year of the whole table."""
    cells = V.apps(spark, folder).groupBy("yr", "nation").agg(
        F.count("*").alias("n"), F.sum("amount").cast("double").alias("volume")
    )
    return K.top_in_latest(cells, "yr", F.col("n") >= 20, [F.desc("volume"), F.asc("nation")], 12)


QUERIES = {
    "current_release": current_release,
    "as_of_date": as_of_date,
    "as_of_rows": as_of_rows,
    "publication_order": publication_order,
    "release_scope": release_scope,
    "release_registry": release_registry,
    "release_delta": release_delta,
    "latest_manifest": latest_manifest,
    "source_inventory_diff": source_inventory_diff,
    "source_decision": source_decision,
    "pending_loads": pending_loads,
    "latest_per_key": latest_per_key,
    "dimension_precedence": dimension_precedence,
    "topk_global": topk_global,
    "topk_latest": topk_latest,
}

_CELLS = (
    "cells AS (SELECT yr, release, count(*) AS n, count(*) FILTER (outcome = 3) AS denied FROM released "
    "GROUP BY yr, release)"
)
_H = (
    "h AS (SELECT " + ", ".join(f"{sql} AS {n}" for n, sql in _HISTORY.items())
    + " FROM documents WHERE doc_id % 13 <> 0), "
    "hl AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY source, part ORDER BY doc DESC) = 1)"
)
_L = (
    "lst AS (SELECT " + ", ".join(f"{sql} AS {n}" for n, sql in _LISTING.items()) + " FROM documents), "
    "ll AS (SELECT * FROM lst QUALIFY row_number() OVER (PARTITION BY source, part ORDER BY doc DESC) = 1)"
)
_DIFF = (
    f"{_H}, {_L}, lk AS (SELECT * FROM ll WHERE part % 17 <> 3), "
    "d AS (SELECT coalesce(hl.source, lk.source) AS source, coalesce(hl.part, lk.part) AS part, "
    "CASE WHEN lk.error IS NOT NULL THEN 'error' WHEN lk.source IS NULL THEN 'not listed' "
    "WHEN hl.source IS NULL THEN 'never loaded' WHEN hl.etag <> lk.etag OR hl.bytes <> lk.bytes THEN 'republished' "
    "ELSE 'equal' END AS state, hl.bytes AS loaded_bytes, lk.bytes AS listed_bytes "
    "FROM hl FULL JOIN lk ON hl.source = lk.source AND hl.part = lk.part)"
)
_ASKED = ", ".join(f"(DATE '{d.isoformat()}')" for d in DAYS)

ORACLE = {
    "current_release": f"WITH {_CELLS}, m AS (SELECT yr, arg_max(release, maturity) AS release FROM registry GROUP BY yr) "
    "SELECT yr, release, n, denied FROM m JOIN cells USING (yr, release)",
    "as_of_date": f"WITH {_CELLS}, q(as_of) AS (VALUES {_ASKED}), "
    "v AS (SELECT as_of, yr, arg_max(release, maturity) AS release FROM q JOIN registry ON frozen_at <= as_of GROUP BY as_of, yr) "
    "SELECT as_of, yr, release, n, denied FROM v JOIN cells USING (yr, release)",
    "as_of_rows": "WITH p AS (SELECT yr, release, maturity, frozen_at, coalesce(maturity > max(maturity) OVER (PARTITION BY yr "
    "ORDER BY frozen_at, maturity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS effective FROM registry), "
    "h AS (SELECT yr, frozen_at, arg_max(release, maturity) AS release FROM p WHERE effective GROUP BY yr, frozen_at), "
    "o AS (SELECT cast(year(o_orderdate) AS int) AS yr, cast(o_orderdate AS date) + cast(o_orderkey % 1500 AS int) AS day FROM orders) "
    "SELECT o.yr, h.release, count(*) AS n, min(day) AS first_day, max(day) AS last_day "
    "FROM o ASOF LEFT JOIN h ON o.yr = h.yr AND o.day >= h.frozen_at GROUP BY o.yr, h.release",
    "publication_order": "SELECT yr, release, frozen_at, row_number() OVER (ORDER BY frozen_at, yr, maturity) AS position, "
    "coalesce(maturity > max(maturity) OVER (PARTITION BY yr ORDER BY frozen_at, maturity "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS takes_effect FROM registry",
    "release_scope": "SELECT yr, release, maturity FROM registry r WHERE yr IN (1997, 1998) OR "
    "maturity = (SELECT max(maturity) FROM registry s WHERE s.yr = r.yr)",
    "release_registry": "SELECT yr, release, frozen_at, n_rows + CASE release WHEN 'first' THEN 1 ELSE 0 END AS n_rows, "
    "cast(frozen_at + CASE release WHEN 'first' THEN 30 ELSE 1 END AS date) AS applied_at FROM registry",
    "release_delta": "SELECT yr, release, n_rows, n_rows - lag(n_rows) OVER (PARTITION BY yr ORDER BY maturity) AS added FROM registry",
    "latest_manifest": f"WITH {_H} SELECT source, part, doc, etag, bytes FROM hl",
    "source_inventory_diff": f"WITH {_DIFF} SELECT * FROM d",
    "source_decision": f"WITH {_DIFF} SELECT count(*) AS sources, count(*) FILTER (state IN ('error', 'not listed')) AS unknown, "
    "bool_or(state IN ('republished', 'never loaded')) AS must_run, "
    "count(*) FILTER (state IN ('error', 'not listed')) = 0 AS decidable FROM d",
    "pending_loads": f"WITH {_H}, {_L} SELECT ll.source, ll.part, ll.doc, ll.etag FROM ll LEFT JOIN hl "
    "ON ll.source = hl.source AND ll.part = hl.part AND ll.etag = hl.etag WHERE hl.source IS NULL",
    "latest_per_key": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER "
    "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
    "dimension_precedence": "SELECT o_custkey AS c_custkey, count(*) AS n, CASE WHEN o_custkey % 3 <> 0 THEN any_value(c_name) "
    "WHEN o_custkey % 5 <> 0 THEN upper(any_value(c_name)) ELSE cast(o_custkey AS varchar) END AS name "
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey",
    "topk_global": "SELECT entity, count(*) AS n FROM apps GROUP BY entity ORDER BY n DESC, entity LIMIT 12",
    "topk_latest": "SELECT yr, nation, count(*) AS n, cast(sum(amount) AS double) AS volume FROM apps "
    "WHERE yr = (SELECT max(yr) FROM apps) GROUP BY yr, nation HAVING count(*) >= 20 ORDER BY volume DESC, nation LIMIT 12",
}
