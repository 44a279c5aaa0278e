"""Samples that come out the same on any layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.fingerprint import row_fingerprint

#: Resolution of the sampling threshold.
STEPS = 1_000_000


def hash_draw(columns: Sequence[str], seed: int) -> Column:
    """A number in [0, STEPS) that depends only on the values and the seed."""
    first, second = row_fingerprint(columns)
    return F.pmod(F.xxhash64(F.lit(seed), first, second), F.lit(STEPS))


def sample_rows(df: DataFrame, fraction: float, draw: Column) -> DataFrame:
    """Rows whose draw is below the threshold, at the same rate in every stratum.

    A filter on the scan: no shuffle, and the same rows whatever the partitioning, which
    seeded sampling operators do not give.
    """
    if not 0 < fraction <= 1:
        raise ValueError(f"fraction must be in (0, 1], not {fraction}")
    return df.where(draw < F.lit(round(fraction * STEPS)))


def public_columns(df: DataFrame, internal_prefix: str = "_") -> DataFrame:
    """Without internal columns."""
    return df.select(*[c for c in df.columns if not c.startswith(internal_prefix)])
