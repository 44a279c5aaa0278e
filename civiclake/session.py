"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution does the sizing: start with many small shuffle partitions and let it
#: coalesce them, split skewed ones and re-plan joins on measured sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
    # The JVM never compiles methods above 8000 bytes of bytecode. A stage whose generated
    # method is larger (dozens of cleaning rules) runs several times faster as separately
    # generated, split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Accepted and rejected rows go to two open files; otherwise each task sorts its wide rows
    # by that one flag. A write with more partitions in a task sorts the rest as before.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    # Rows go to Python in batches of 10,000, whatever they hold; texts and pages need a bound in bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

#: Those of the above that a running session can still take.
RUNTIME = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.maxConcurrentOutputFileWriters")
#: What queries need that hand texts, pages or vectors to Python.
BATCHES = ("spark.sql.execution.arrow.maxBytesPerBatch",)


def tune(spark: SparkSession, keys: tuple[str, ...] = RUNTIME) -> SparkSession:
    """Give an existing session the runtime settings its owner did not choose."""
    chosen = spark.sparkContext.getConf()
    for key in keys:
        if not chosen.contains(key):
            spark.conf.set(key, DEFAULTS[key])
    return spark


def build_session(
    app: str = "civiclake", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the defaults above; `settings` wins over them.

    On a cluster leave `master` to spark-submit. `spark.sql.shuffle.partitions` is not set
    here: size it as total shuffle bytes / 128 MB and let adaptive execution coalesce.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
