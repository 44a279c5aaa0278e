"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Problems found; an empty list means equal columns, types and rows."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        wanted = _KINDS.get(kind, kind.upper())
        if wanted != kinds[field.name].replace(" ", ""):
            problems.append(f"type of {field.name}: {kind} vs {kinds[field.name]}")
    order = sorted(names)
    got = Counter(tuple(_plain(r[c]) for c in order) for r in df.collect())
    want = Counter(tuple(_plain(r[names.index(c)]) for c in order) for r in expected)
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        problems.append(
            f"rows {sum(got.values())} vs {sum(want.values())}; columns {order}; "
            f"only Spark {extra}; only DuckDB {missing}"
        )
    return problems


def local_session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("civiclake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
