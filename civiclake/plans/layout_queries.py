"""Query catalogue: named tables, pruning, clustering. Plans and files, not only results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.plans import layout as Y
from civiclake.plans import views as V
from civiclake.sources import catalog as C
from civiclake.sources import publishing as P
from civiclake.sources.scratch import new_dir, stage


def _table(spark: SparkSession, folder: str, table: str) -> str:
    rows = V.apps(spark, folder).select("app_id", "yr", "place1", "nation", "outcome", "amount")
    return C.create_as(P.balanced(rows, "yr"), "civiclake", table, new_dir(spark, "table"), "yr")


#: Questions as (condition on the partition, condition on another column), for Spark and for SQL.
_ASKED = {
    "one year": ("yr = 1998", "true"),
    "years and outcome": ("yr BETWEEN 1996 AND 1998", "outcome = 3"),
    "nation": ("true", "nation = 'NATION_3'"),
    "everything": ("true", "true"),
}


def ctas_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    name = _table(spark, folder, "ctas")
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    counted = spark.sql(f"SELECT yr, count(*) AS n, max(app_id) AS last FROM {name} GROUP BY yr")
    return counted.withColumn("partitioned_by", F.lit(",".join(parts)))


def catalog_register(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables of one lake registered together, twice, the second time at another place."""
    rows = V.apps(spark, folder).select("app_id", "yr", "outcome")
    first, second, log = (new_dir(spark, f"place-{i}") for i in range(3))
    P.create_table(P.balanced(rows.where("outcome = 1"), "yr"), first, "yr")
    P.create_table(P.balanced(rows, "yr"), second, "yr")
    P.append_log(rows.select("outcome").distinct(), log)
    C.register_tables(spark, "civiclake", {"applications": first, "outcomes": log})
    names = C.register_tables(spark, "civiclake", {"applications": second, "outcomes": log})
    return spark.sql(
        f"SELECT yr, outcome, count(*) AS n FROM {names['applications']} JOIN {names['outcomes']} USING (outcome) GROUP BY yr, outcome"
    )


def pruned_count(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per year of each question, asked of the catalogued table."""
    name = _table(spark, folder, "pruned")
    parts = [
        spark.sql(f"SELECT yr, count(*) AS n FROM {name} WHERE {pruning} AND {rest} GROUP BY yr").select(
            F.lit(label).alias("question"), "yr", "n"
        )
        for label, (pruning, rest) in _ASKED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _folders(spark: SparkSession, folder: str, table: str) -> DataFrame:
    stored = spark.table(_table(spark, folder, table))
    parts = [
        Y.folders_opened(stored, "yr", F.expr(pruning), F.expr(rest)).select(F.lit(label).alias("question"), "yr", "n_rows", "n_wanted")
        for label, (pruning, rest) in _ASKED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def files_read(spark: SparkSession, folder: str) -> DataFrame:
    """Folders that the scan of each question opened, by its own count, and the rows asked for."""
    stored = spark.table(_table(spark, folder, "files"))
    parts = []
    for label, (pruning, rest) in _ASKED.items():
        asked = stored.where(f"{pruning} AND {rest}")
        folders, files = Y.opened(asked.select("app_id"))
        counted = asked.agg(F.count(F.lit(1)).alias("n_wanted"))
        parts.append(counted.select(F.lit(label).alias("question"), F.lit(folders).cast("long").alias("folders"), F.lit(files >= folders).alias("has_files"), "n_wanted"))
    return reduce(DataFrame.unionByName, parts)


def partition_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Range of folders each question is confined to, and the rows in them."""
    return _folders(spark, folder, "filters").groupBy("question").agg(
        F.min("yr").alias("first_yr"), F.max("yr").alias("last_yr"), F.sum("n_rows").alias("n_rows")
    )


def pruning_report(spark: SparkSession, folder: str) -> DataFrame:
    """Folders opened and the share of their rows that a question asks for."""
    return _folders(spark, folder, "report").groupBy("question").agg(
        F.count(F.lit(1)).alias("folders"), F.round(F.sum("n_wanted") / F.sum("n_rows"), 6).alias("share_wanted")
    )


def cluster_experiment(spark: SparkSession, folder: str) -> DataFrame:
    """A filter must open fewer files of the clustered copy; both hold the same rows."""
    rows = stage(V.apps(spark, folder).select("app_id", "yr", "nation", "outcome"), "source")
    measured = Y.cluster_experiment(rows, "nation", "NATION_3", Y.as_many_files(rows))
    return measured.select("layout", "n_rows", (F.col("files_overlapping") < F.col("files")).alias("skips_files"))


def files_overlapping(spark: SparkSession, folder: str) -> DataFrame:
    """Value ranges of the files of a clustered copy: they cover all rows and rarely overlap."""
    rows = stage(V.apps(spark, folder).select("app_id", "yr", "purpose"), "source")
    path = new_dir(spark, "clustered")
    Y.clustered_copy(rows, "purpose", Y.as_many_files(rows), path)
    ranges = Y.file_ranges(spark.read.schema(rows.schema).parquet(path), "purpose")
    hit = Y.overlapping(ranges, "2-HIGH")
    return hit.select("n_rows", (F.col("files_overlapping") < F.col("files")).alias("skips_files"),
                      (F.col("files_overlapping") > 0).alias("finds_value"))


QUERIES = {
    "ctas_partitioned": ctas_partitioned,
    "catalog_register": catalog_register,
    "pruned_count": pruned_count,
    "files_read": files_read,
    "partition_filters": partition_filters,
    "pruning_report": pruning_report,
    "cluster_experiment": cluster_experiment,
    "files_overlapping": files_overlapping,
}

_OPENED = " UNION ALL ".join(
    f"SELECT '{label}' AS question, yr, count(*) AS n_rows, count(*) FILTER ({rest}) AS n_wanted FROM apps WHERE {pruning} GROUP BY yr"
    for label, (pruning, rest) in _ASKED.items()
)

ORACLE = {
    "ctas_partitioned": "SELECT yr, count(*) AS n, max(app_id) AS last, 'yr' AS partitioned_by FROM apps GROUP BY yr",
    "catalog_register": "SELECT yr, outcome, count(*) AS n FROM apps GROUP BY yr, outcome",
    "pruned_count": f"SELECT question, yr, n_wanted AS n FROM ({_OPENED}) WHERE n_wanted > 0",
    "files_read": "SELECT question, count(*) AS folders, true AS has_files, cast(sum(n_wanted) AS bigint) AS n_wanted "
    f"FROM ({_OPENED}) GROUP BY question",
    "partition_filters": "SELECT question, min(yr) AS first_yr, max(yr) AS last_yr, cast(sum(n_rows) AS bigint) AS n_rows "
    f"FROM ({_OPENED}) GROUP BY question",
    "pruning_report": "SELECT question, count(*) AS folders, round(sum(n_wanted) / sum(n_rows), 6) AS share_wanted "
    f"FROM ({_OPENED}) GROUP BY question",
    "cluster_experiment": "SELECT l.layout, count(*) AS n_rows, l.layout = 'clustered' AS skips_files FROM apps, "
    "(VALUES ('shuffled'), ('clustered')) l(layout) GROUP BY l.layout",
    "files_overlapping": "SELECT count(*) AS n_rows, true AS skips_files, true AS finds_value FROM apps",
}
