"""Writing tables: every write is a new version, and readers follow a log of switches.

A partition of a published table is a folder of versions, `root/year=2021/version=...`. A write makes
a version of its own, checked while it is written and counted from its files; only then an entry of the
numbered log `root/_versions` switches readers to it. A write that fails, is refused or loses an executor
leaves a folder that nobody reads, and what was published before stays as it is. Of several writers each
gets a number of its own; the highest is in force, whatever their clocks say. What no reader can
reach any more is removed by `retire`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.operators.ranking import latest_per_key
from civiclake.sources import commits
from civiclake.sources.landing import LoadRefused

#: The log lies below the table's root; scans of a root skip names that start with an underscore.
VERSIONS = "_versions"
_SWITCHES = "place string, version string, rows bigint, switched_at timestamp"

#: How long a version that was replaced, or never switched to, stays for readers and writers under way.
GRACE = timedelta(days=7)


def partition_dir(root: str, partition: Mapping[str, object]) -> str:
    """Folder of one partition; values that would need escaping are refused."""
    for name, value in partition.items():
        if not str(value).replace("_", "").replace("-", "").isalnum():
            raise ValueError(f"partition value {value!r} of {name} is not a plain name")
    return "/".join([root, *[f"{name}={value}" for name, value in partition.items()]])


def publish(
    df: DataFrame,
    root: str,
    partition: Mapping[str, object],
    expected: int | None = None,
    inner: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
    rules: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Make `df` the content of one partition; other partitions are not touched.

    The rows are written once: `rows` is counted from the footers of what was written, the conditions in
    `counts` by the writing job. With another number of rows than `expected` the
    load is refused, and so it is if a row breaks one of `rules` (name -> SQL condition; NULL
    counts as broken). Rules may also sit in `df` (`quality.guarded`), where one fails the job. In
    all cases there is no switch. `inner` are columns that partition the version
    itself. Returns the counts.
    """
    version = uuid.uuid4().hex
    data = df.drop(*partition)
    folder = partition_dir(root, {**partition, "version": version})
    totals = [F.count_if(test).alias(name) for name, test in (counts or {}).items()]
    broken = [F.count_if(~F.coalesce(F.expr(test), F.lit(False))).alias(f"rule {name}") for name, test in (rules or {}).items()]
    seen = Observation()
    watched = data.observe(seen, *totals, *broken) if totals or broken else data
    watched.write.mode("errorifexists").partitionBy(*inner).parquet(folder)
    found = {"rows": df.sparkSession.read.schema(data.schema).parquet(folder).count(), **(seen.get if totals or broken else {})}
    failing = [name for name in rules or () if found.pop(f"rule {name}")]
    if failing:
        raise LoadRefused(f"check failed: {', '.join(failing)}; {dict(partition)} left unchanged")
    if expected is not None and found["rows"] != expected:
        raise LoadRefused(f"expected {expected} rows, wrote {found['rows']}; {dict(partition)} left unchanged")
    place = partition_dir("", partition).lstrip("/")
    switch = df.sparkSession.createDataFrame([(place, version, found["rows"], None)], _SWITCHES)
    commits.append(switch.withColumn("switched_at", F.current_timestamp()), f"{root}/{VERSIONS}")
    return found


def publish_all(df: DataFrame, root: str, *partitions: str) -> None:
    """Publish every partition of `df` in one job and one commit; partitions it does not have stay as they are."""
    version = uuid.uuid4().hex
    plain = [F.col(p).cast("string").rlike("^[A-Za-z0-9_-]+$") for p in partitions]
    known = df
    for name, test in zip(partitions, plain, strict=True):
        known = known.where(F.when(test, True).otherwise(F.raise_error(F.lit(f"a value of {name} is not a plain name")).cast("boolean")))
    rows = balanced(known, *partitions).withColumn("version", F.lit(version))
    rows.write.mode("append").partitionBy(*partitions, "version").parquet(root)
    # Only folders of this version are listed, not those of all versions.
    written = "/".join([root, *("*" for _ in partitions), f"version={version}"])
    data = StructType([f for f in df.schema if f.name not in partitions])
    try:
        stored = df.sparkSession.read.schema(data).option("basePath", root).parquet(written)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return  # there was no row to publish
    parts = F.reverse(F.split(F.col("_metadata.file_path"), "/"))
    place = F.concat_ws("/", F.reverse(F.slice(parts, 3, len(partitions))))
    switches = stored.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("rows")).select("place", F.lit(version).alias("version"), "rows")
    commits.append(switches.withColumn("switched_at", F.current_timestamp()), f"{root}/{VERSIONS}")


def current_versions(spark: SparkSession, root: str, at: int | None = None) -> DataFrame:
    """`place`, `version`, `rows`, `switched_at`, `commit` of each published partition, now or after commit `at`."""
    return latest_per_key(commits.read(spark, f"{root}/{VERSIONS}", _SWITCHES, at), ["place"], [F.desc("commit")])


def retire(spark: SparkSession, root: str, keep: Iterable[int] = (), grace: timedelta = GRACE) -> DataFrame:
    """Remove the versions no reader can reach, and return them as (`place`, `version`, `was_published`).

    Readers reach what is in force now and what was in force after each commit of `keep` (open reads as of an
    earlier state). Others go once they have been replaced for `grace`; folders that were never switched to,
    from writes that failed, once they are that old. The clock only delays removal, it decides nothing else.
    The driver lists folders and versions (one each a partition and write), never rows.
    """
    log = commits.read(spark, f"{root}/{VERSIONS}", _SWITCHES)
    limit = F.lit(datetime.now(UTC) - grace)
    reachable = [current_versions(spark, root, at).select("place", "version") for at in (None, *keep)]
    next_switch = F.lead("switched_at").over(Window.partitionBy("place").orderBy("commit"))
    replaced = log.withColumn("replaced_at", next_switch).where(F.col("replaced_at") <= limit)
    old = replaced.join(reduce(DataFrame.union, reachable), ["place", "version"], "left_anti").select("place", "version", F.lit(True).alias("was_published"))
    known = {(r["place"], r["version"]) for r in log.select("place", "version").collect()}
    fs, top = commits._files(spark, root)
    before = (datetime.now(UTC) - grace).timestamp() * 1000
    stray, level = [], [(top, "")]
    while level and fs.exists(top):
        inner = []
        for folder, place in level:
            for status in fs.listStatus(folder):
                name = status.getPath().getName()
                if name.startswith("version="):
                    version = name.removeprefix("version=")
                    if (place, version) not in known and status.getModificationTime() <= before:
                        stray.append((place, version, False))
                elif status.isDirectory() and "=" in name:
                    inner.append((status.getPath(), f"{place}/{name}".lstrip("/")))
        level = inner
    gone = [*map(tuple, old.collect()), *stray]
    for place, version, _ in gone:
        folder = f"{root}/{place}/version={version}" if place else f"{root}/version={version}"
        fs.delete(commits._files(spark, folder)[1], True)
    return spark.createDataFrame(gone, "place string, version string, was_published boolean")


def read_current(spark: SparkSession, root: str, schema: StructType, at: int | None = None) -> DataFrame:
    """What is published, now or after commit `at`, with the declared schema ('01' stays text).

    The list of folders has one entry for each partition; conditions on partition columns still prune.
    """
    chosen = current_versions(spark, root, at).select("place", "version").collect()
    if not chosen:
        return spark.createDataFrame([], schema)
    folders = sorted(f"{root}/{r['place']}/version={r['version']}" for r in chosen)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select(*schema.names)


def read_table(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Scan of a partitioned table without versions, with its declared schema."""
    return spark.read.schema(schema).parquet(root)


def create_table(df: DataFrame, path: str, *partitions: str) -> None:
    """First write of a table; an existing one is not overwritten."""
    df.write.mode("errorifexists").partitionBy(*partitions).parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Whole-table overwrite; the schema may differ from the one before."""
    df.write.mode("overwrite").parquet(path)


def append_log(records: DataFrame, path: str) -> None:
    """Append to a control log."""
    records.write.mode("append").parquet(path)


def write_extract(df: DataFrame, path: str, files: int) -> None:
    """An extract to carry away, in as many files as its reader wants."""
    df.repartition(files).write.mode("errorifexists").parquet(path)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Co-locate partition values before a partitioned write, with big ones split.

    REBALANCE lets adaptive execution cut a hot value into several tasks and files.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])
