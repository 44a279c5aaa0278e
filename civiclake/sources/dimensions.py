"""Reference dimensions: several vintages of names, nested official counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.operators.ranking import latest_per_key


def with_precedence(vintages: Sequence[DataFrame], key: Sequence[str], last_wins: bool = False) -> DataFrame:
    """One row per key from several vintages; the earliest (or latest) vintage wins."""
    ranked = [df.withColumn("_vintage", F.lit(i)) for i, df in enumerate(vintages)]
    union = reduce(DataFrame.unionByName, ranked)
    order = F.desc("_vintage") if last_wins else F.asc("_vintage")
    return latest_per_key(union, key, [order]).drop("_vintage")


def lookup(df: DataFrame, names: DataFrame, key: Sequence[str], name: str, default: Column | None = None) -> DataFrame:
    """Attach a name. Without `default`, rows whose key is unknown are dropped."""
    if default is None:
        return df.join(names, list(key))
    found = df.join(names, list(key), "left")
    return found.withColumn(name, F.coalesce(F.col(name), default))


def flatten_counts(documents: DataFrame, text: str, levels: Sequence[str], value_schema: str) -> DataFrame:
    """Nested JSON {a: {b: value}} to rows (a, b, value fields), one explode per level."""
    kind = value_schema
    for _ in levels:
        kind = f"map<string,{kind}>"
    kept = [c for c in documents.columns if c != text]
    current = documents.select(*kept, F.from_json(F.col(text), kind).alias("_node"))
    for level in levels:
        current = current.select(*kept, F.explode("_node").alias(level, "_node"))
        kept = [*kept, level]
    return current.select(*kept, "_node.*")
