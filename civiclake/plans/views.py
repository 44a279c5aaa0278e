"""Derived inputs over the given tables.

The expressions are plain SQL that Spark and DuckDB read alike, so both engines start from
the same rows. Everything else is written twice: with the operators here, by hand in the
checking SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _select(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in exprs.items()])


def _sql(exprs: dict[str, str], source: str, where: str = "") -> str:
    body = ", ".join(f"{sql} AS {name}" for name, sql in exprs.items())
    return f"SELECT {body} FROM {source}" + (f" WHERE {where}" if where else "")


# --- the register: one row per application, with two place levels -------------------------

APPS = {
    "app_id": "o_orderkey",
    "yr": "cast(year(o_orderdate) as int)",
    "place1": "r_name",
    "place2": "case when n_nationkey = 24 then '99999' when n_nationkey = 23 then null else n_name end",
    "nation": "n_name",
    "outcome": "case o_orderstatus when 'O' then 1 when 'P' then 2 else 3 end",
    "purpose": "o_orderpriority",
    "ltype": "c_mktsegment",
    "entity": "c_custkey % 97",
    "amount": "cast(o_totalprice as decimal(18,2))",
    "income": "cast(c_acctbal as decimal(18,2))",
    "rate": "case when o_orderkey % 9 = 0 then null else cast((o_orderkey % 1300) as decimal(18,3)) / 100 end",
    "closed_end": "case when o_orderkey % 23 = 0 then null else o_orderkey % 29 <> 0 end",
    "owner_occupied": "case when o_custkey % 31 = 0 then 2 else 1 end",
    "units": "case when o_custkey % 37 = 0 then '5-24' else '1' end",
}
_APPS_FROM = (
    "orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
APPS_SQL = _sql(APPS, _APPS_FROM)


def apps(spark: SparkSession, folder: str) -> DataFrame:
    t = {n: table(spark, folder, n) for n in ("orders", "customer", "nation", "region")}
    joined = (
        t["orders"]
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return _select(joined, APPS)


# --- three releases of the register per year ----------------------------------------------
# The first release misses some rows and carries some other outcomes; the last is complete.

RELEASES = ("first", "middle", "final")
_RELEASE_FILTER = {
    "first": "app_id % 50 <> 0",
    "middle": "app_id % 53 <> 0",
    "final": "true",
}
_RELEASE_OUTCOME = {
    "first": "case when app_id % 61 = 0 then 3 else outcome end",
    "middle": "case when app_id % 127 = 0 then 1 else outcome end",
    "final": "outcome",
}
_RELEASE_CARRIED = ("app_id", "yr", "place1", "place2", "purpose", "amount", "income", "closed_end",
                    "owner_occupied", "units", "entity")
RELEASED_SQL = " UNION ALL ".join(
    f"SELECT {', '.join(_RELEASE_CARRIED)}, {_RELEASE_OUTCOME[r]} AS outcome, '{r}' AS release "
    f"FROM apps WHERE {_RELEASE_FILTER[r]}"
    + (" AND yr < 2001" if r == "final" else "")
    for r in RELEASES
)


def released_apps(spark: SparkSession, folder: str) -> DataFrame:
    """All releases in one table, as it is stored: partitions (yr, release).

    The newest year has no final release yet. One pass over the register, then each row is
    emitted once per release that carries it.
    """
    versions = [
        F.when(
            F.expr(_RELEASE_FILTER[r] + (" AND yr < 2001" if r == "final" else "")),
            F.struct(F.lit(r).alias("release"), F.expr(_RELEASE_OUTCOME[r]).alias("outcome")),
        )
        for r in RELEASES
    ]
    return (
        apps(spark, folder)
        .select(*_RELEASE_CARRIED, "outcome")
        .select(*_RELEASE_CARRIED, F.explode(F.array(*versions)).alias("v"))
        .where(F.col("v").isNotNull())
        .select(*_RELEASE_CARRIED, "v.outcome", "v.release")
    )


#: Registry: when each release was frozen. Derived from the years present in the register.
REGISTRY = {
    "yr": "yr",
    "release": "release",
    "maturity": "case release when 'first' then 0 when 'middle' then 1 else 2 end",
    "frozen_at": "case release when 'first' then make_date(yr + 1, 5, 1 + yr % 7) "
    "when 'middle' then make_date(yr + 2, 5, 1 + (yr + 1) % 7) "
    "else make_date(yr + 3, 12, 31) end",
    "n_rows": "n_rows",
}
REGISTRY_SQL = _sql(
    REGISTRY, "(SELECT yr, release, count(*) AS n_rows FROM released GROUP BY yr, release)"
)


def registry(spark: SparkSession, folder: str) -> DataFrame:
    counts = released_apps(spark, folder).groupBy("yr", "release").agg(F.count("*").alias("n_rows"))
    return _select(counts, REGISTRY)


# --- key-less releases of the line items ---------------------------------------------------

_REL = {
    "yr": "cast(year(l_shipdate) as int)",
    "sk": "l_suppkey",
    "q": "cast(l_quantity as int)",
    "fl": "l_returnflag",
    "ls": "l_linestatus",
    "dc": "cast(round(l_discount * 100) as int)",
}
COMPARED = ("sk", "q", "fl", "ls", "dc")
_REL_EDITS = {
    "a": {},
    "b": {
        "q": "cast(l_quantity as int) + case when l_partkey % 31 = 0 then 1 else 0 end",
        "fl": "case when l_partkey % 67 = 0 then 'Z' else l_returnflag end",
    },
    "c": {
        "q": "cast(l_quantity as int) + case when l_partkey % 31 = 0 then 1 else 0 end",
        "fl": "case when l_partkey % 67 = 0 then null else l_returnflag end",
        "ls": "case when l_orderkey % 71 = 0 then 'X' else l_linestatus end",
    },
}
_REL_FILTER = {"a": "l_orderkey % 50 <> 0", "b": "l_orderkey % 53 <> 0", "c": "l_orderkey % 59 <> 0"}


def rel(spark: SparkSession, folder: str, which: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").where(_REL_FILTER[which])
    return _select(rows, {**_REL, **_REL_EDITS[which]})


def rel_sql(which: str) -> str:
    return _sql({**_REL, **_REL_EDITS[which]}, "lineitem", _REL_FILTER[which])


# --- the raw landing table: text only, with markers and damage -----------------------------

_QTY = "cast(cast(l_quantity as decimal(18,2)) as varchar(40))"
RAW = {
    "rk": "l_orderkey",
    "rl": "l_linenumber",
    "pk": "l_partkey",
    "yr": "cast(year(l_shipdate) as int)",
    "yr_t": "case when l_orderkey % 389 = 0 then '1901' "
    "else cast(year(l_shipdate) as varchar(10)) end",
    "qty_t": "case when l_orderkey % 41 = 0 then 'NA' when l_orderkey % 43 = 0 then 'Exempt' "
    f"when l_partkey % 97 = 0 then 'abc' else {_QTY} end",
    "price_t": "case when l_partkey % 37 = 0 then '' when l_orderkey % 47 = 0 then 'NA' "
    "when l_partkey % 211 = 0 then '12,5' "
    "else cast(cast(l_extendedprice as decimal(18,2)) as varchar(40)) end",
    "code_t": "case when l_suppkey % 29 = 0 then '1111' when l_partkey % 101 = 0 then '9' "
    "when l_orderkey % 83 = 0 then '' else cast(l_linenumber as varchar(10)) end",
    "yn_t": "case when l_orderkey % 59 = 0 then '1111' when l_partkey % 103 = 0 then '3' "
    "when l_linestatus = 'O' then '1' else '2' end",
    "band_t": "case when l_orderkey % 79 = 0 then 'NA' when l_partkey % 107 = 0 then '35' "
    "when l_partkey % 71 = 0 then '>60%' "
    "when l_quantity < 12 then '<20%' when l_quantity < 24 then '20%-<30%' "
    "when l_quantity < 36 then '30%-<36%' when l_quantity < 50 then cast(cast(l_quantity as int) as varchar(10)) "
    "else '50%-60%' end",
    "flag_t": "case when l_partkey % 109 = 0 then 'X' when l_orderkey % 61 = 0 then 'NA' "
    "else l_returnflag end",
    "place_t": "case when l_suppkey % 17 = 0 then 'NA' "
    "else concat('S', cast(l_suppkey % 50 as varchar(10))) end",
    "rate_t": "case when l_partkey % 113 = 0 then '812345' when l_orderkey % 67 = 0 then '-1.5' "
    "when l_orderkey % 71 = 0 then 'NA' "
    "else cast(cast(l_tax * 100 as decimal(18,3)) as varchar(40)) end",
    "spread_t": "case when l_partkey % 127 = 0 then '-7654321' when l_orderkey % 53 = 0 then 'Exempt' "
    "else cast(cast(l_discount * 10 as decimal(18,3)) as varchar(40)) end",
    "age_t": "case when l_partkey % 131 = 0 then '9999' when l_orderkey % 73 = 0 then '8888' "
    "when l_partkey % 137 = 0 then '17' when l_quantity < 25 then '<25' else '25-34' end",
    "whole_t": "case when l_orderkey % 89 = 0 then '7.5' "
    "else cast(cast(l_quantity as decimal(18,1)) as varchar(40)) end",
    "reason_t": "case when l_partkey % 139 = 0 then '1111' when l_returnflag = 'R' "
    "then cast(l_linenumber % 4 + 1 as varchar(10)) else '10' end",
    "co_t": "case when l_orderkey % 97 = 0 then 'NA' "
    "else cast(l_linenumber % 6 + 1 as varchar(10)) end",
}
RAW_TEXT = tuple(name for name in RAW if name.endswith("_t"))
RAW_SQL = _sql(RAW, "lineitem")


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return _select(table(spark, folder, "lineitem"), RAW)


def with_views(sql: str) -> str:
    """Prefix a checking query with the views its text mentions."""
    known = {
        "apps": APPS_SQL,
        "released": RELEASED_SQL,
        "registry": REGISTRY_SQL,
        "rel_a": rel_sql("a"),
        "rel_b": rel_sql("b"),
        "rel_c": rel_sql("c"),
        "raw": RAW_SQL,
    }
    needed = {name for name in known if _mentions(sql, name)}
    if "registry" in needed:
        needed.add("released")
    if "released" in needed:
        needed.add("apps")
    views = [f"{name} AS ({known[name]})" for name in known if name in needed]
    if not views:
        return sql
    rest = sql.strip()
    if rest.upper().startswith("WITH "):
        return "WITH " + ", ".join(views) + ", " + rest[5:]
    return "WITH " + ", ".join(views) + " " + rest


def _mentions(sql: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", sql) is not None
