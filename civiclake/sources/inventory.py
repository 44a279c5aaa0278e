"""What is loaded, what is published, and what has to be done about it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.operators.ranking import latest_per_key


def latest_manifest(history: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """Current entry per source from the full publication history."""
    return latest_per_key(history, key, [F.desc(at)])


def pending_loads(
    candidates: DataFrame, load_log: DataFrame, key: Sequence[str], content: str, at: str, force: bool = False
) -> DataFrame:
    """Candidates whose content differs from the last recorded load (all of them when forced)."""
    if force:
        return candidates
    last = latest_per_key(load_log, key, [F.desc(at)]).select(*key, content)
    return candidates.join(last, [*key, content], "left_anti")


def inventory_diff(manifest: DataFrame, listing: DataFrame, key: Sequence[str]) -> DataFrame:
    """State of every source: both sides have `etag` and `bytes`, the listing also `error`.

    equal, republished (etag or size differs), never loaded, not listed, or error.
    """
    mine = manifest.select(*key, F.col("etag").alias("_etag"), F.col("bytes").alias("_bytes"), F.lit(True).alias("_mine"))
    theirs = listing.select(*key, "etag", "bytes", "error", F.lit(True).alias("_theirs"))
    differs = ~(F.col("_etag").eqNullSafe(F.col("etag")) & F.col("_bytes").eqNullSafe(F.col("bytes")))
    state = (
        F.when(F.col("error").isNotNull(), "error")
        .when(F.col("_theirs").isNull(), "not listed")
        .when(F.col("_mine").isNull(), "never loaded")
        .when(differs, "republished")
        .otherwise("equal")
    )
    return mine.join(theirs, list(key), "full_outer").select(
        *key, state.alias("state"), F.col("_bytes").alias("loaded_bytes"), F.col("bytes").alias("listed_bytes")
    )


def decision(states: DataFrame, force: bool = False) -> DataFrame:
    """One row: is there work, and may one say so?

    With any error or unlisted source nobody can claim that nothing changed.
    """
    work = F.bool_or(F.col("state").isin("republished", "never loaded")) | F.lit(force)
    return states.agg(
        F.count("*").alias("sources"),
        F.count_if(F.col("state").isin("error", "not listed")).alias("unknown"),
        F.coalesce(work, F.lit(force)).alias("must_run"),
    ).withColumn("decidable", F.col("unknown") == 0)
