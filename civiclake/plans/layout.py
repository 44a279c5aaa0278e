"""How a table lies in files: rows and value ranges of each, and what clustering does to them."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.sources.scratch import new_dir


def folders_opened(table: DataFrame, partition: str, pruning: Column, wanted: Column) -> DataFrame:
    """The partition folders a question opens: rows in each, and rows that it asks for.

    `pruning` is the condition on the partition column that the question has, `wanted` all of it.
    """
    return (
        table.where(pruning)
        .groupBy(partition)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(wanted).alias("n_wanted"))
    )


def opened(asked: DataFrame) -> tuple[int, int]:
    """Partition folders and files that a question really opens, as its scan counts them; runs the question.

    `asked` is a scan of a partitioned table with conditions and columns chosen, nothing else.
    """
    plan = asked._jdf.queryExecution().executedPlan()
    plan.execute().count()
    metrics = plan.collectLeaves().head().metrics()
    return tuple(int(metrics.get(name).get().value()) for name in ("numPartitions", "numFiles"))


def as_many_files(stored: DataFrame, at_least: int = 8) -> int:
    """Files for a copy of a stored table: as many as it has, so that tasks stay as small."""
    return max(at_least, stored.select("_metadata.file_path").distinct().count())


def shuffled_copy(df: DataFrame, files: int, path: str) -> None:
    """A copy whose files each hold every value."""
    df.repartition(files).write.mode("errorifexists").parquet(path)


def clustered_copy(df: DataFrame, column: str, files: int, path: str) -> None:
    """A copy with as many files, each holding a range of `column`.

    A hash of the row breaks ties, so a value holding much of the table spreads over several
    files instead of one task.
    """
    spread = F.xxhash64(*df.columns)
    ranged = df.repartitionByRange(files, F.col(column), spread)
    ranged.sortWithinPartitions(column).write.mode("errorifexists").parquet(path)


def file_ranges(df: DataFrame, column: str) -> DataFrame:
    """Rows, smallest and largest value of each file of a scan."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n_rows"), F.min(column).alias("low"), F.max(column).alias("high")
    )


def overlapping(ranges: DataFrame, value: object) -> DataFrame:
    """Files, files that may hold `value` by their range, and rows, as one row."""
    may = (F.col("low") <= F.lit(value)) & (F.lit(value) <= F.col("high"))
    return ranges.agg(
        F.count("*").alias("files"),
        F.count_if(may).alias("files_overlapping"),
        F.sum("n_rows").alias("n_rows"),
    )


def cluster_experiment(
    df: DataFrame, column: str, value: object, files: int, runs: int = 0
) -> DataFrame:
    """Files a filter on `column` must open in a shuffled and in a clustered copy.

    With `runs`, also `seconds`, the best time of that many filtered counts.
    """
    spark = df.sparkSession
    paths = {"shuffled": new_dir(spark, "shuffled"), "clustered": new_dir(spark, "clustered")}
    shuffled_copy(df, files, paths["shuffled"])
    clustered_copy(df, column, files, paths["clustered"])
    parts = []
    for layout, path in paths.items():
        copy = spark.read.schema(df.schema).parquet(path)
        measured = overlapping(file_ranges(copy, column), value).withColumn("layout", F.lit(layout))
        if runs:
            filtered = copy.where(F.col(column) == F.lit(value)).agg(F.count("*"))
            measured = measured.withColumn("seconds", F.lit(best_of(filtered, runs)))
        parts.append(measured)
    return parts[0].unionByName(parts[1])


def best_of(df: DataFrame, runs: int = 3) -> float:
    """Best wall time in seconds of reading the whole result without keeping it."""
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return min(times)
