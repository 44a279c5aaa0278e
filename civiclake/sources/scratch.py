"""Intermediate tables in the folder all executors share.

A staged table cuts lineage (a lost executor re-reads files instead of recomputing the
job) and gives Catalyst a measured size, so that later joins pick broadcast or shuffle on
real bytes.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders made for local sessions without `spark.checkpoint.dir`, by application.
_made: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only on local masters."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _made:
        _made[context.applicationId] = tempfile.mkdtemp(prefix="civiclake-")
        context.setCheckpointDir(_made[context.applicationId])
    return _made[context.applicationId]


def new_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and return the scan of what was written."""
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
