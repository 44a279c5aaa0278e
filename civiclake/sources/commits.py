"""Numbered logs: what several writers append, in one order that no clock decides.

An entry is written first, as a folder that nobody reads. It counts from the moment a small file with the
next free number names it. That file appears whole or not at all and only if its number is free; a
writer that comes second takes the number after. Readers go by the numbers alone.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Digits of a number in the name of its file, so that names sort as numbers.
_DIGITS = 20


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create_if_absent(spark: SparkSession, path: str, content: str) -> bool:
    """Make a small file with this content; false, and nothing happens, if there is one.

    The content is written beside it and takes the name in one step: a hard link on a local file
    system, elsewhere a rename that does not replace (atomic on HDFS and its like; an object store
    needs a committer that offers the same).
    """
    jvm = spark._jvm
    fs, target = _files(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            places = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)) for p in (target, aside)]
            jvm.java.nio.file.Files.createLink(*places)
        else:
            options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(aside, False)
    return True


def last_commit(spark: SparkSession, log: str) -> int:
    """The highest number in use; 0 before the first entry."""
    fs, folder = _files(spark, f"{log}/commits")
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def append(entry: DataFrame, log: str) -> int:
    """Append the rows of `entry` together and return the number they got."""
    spark = entry.sparkSession
    mark = uuid.uuid4().hex
    entry.write.mode("errorifexists").parquet(f"{log}/entries/entry={mark}")
    number = last_commit(spark, log) + 1
    while not create_if_absent(spark, f"{log}/commits/{number:0{_DIGITS}d}", mark):
        number += 1
    return number


def read(spark: SparkSession, log: str, schema: str | StructType, up_to: int | None = None) -> DataFrame:
    """All rows of the log (or those up to a number) with their number as `commit`; empty before the first."""
    wanted = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    fs, folder = _files(spark, f"{log}/commits")
    if not fs.exists(folder):
        return spark.createDataFrame([], StructType([*wanted, StructField("commit", LongType())]))
    commits = spark.read.schema("entry string").text(f"{log}/commits").select("entry", F.col("_metadata.file_name").cast("long").alias("commit"))
    entries = spark.read.schema(StructType([*wanted, StructField("entry", StringType())])).parquet(f"{log}/entries")
    if up_to is not None:
        commits = commits.where(F.col("commit") <= up_to)
    return entries.join(commits, "entry").select(*wanted.names, "commit")
