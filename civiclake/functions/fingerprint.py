"""Row identity for rows that have no key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NULL marker and the unit separator of the row text.
NULL_MARK = "\u0000"
UNIT_SEPARATOR = "\u001f"


def row_text(columns: Sequence[str]) -> Column:
    """All values in one string; NULL keeps its place, so ('x', NULL) differs from (NULL, 'x')."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.concat_ws(UNIT_SEPARATOR, *parts)


def _null_safe(columns: Sequence[str]) -> list[Column]:
    # xxhash64 skips NULLs, so each value is preceded by its null flag.
    return [part for c in columns for part in (F.isnull(F.col(c)), F.col(c))]


def row_fingerprint(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits as two longs `h1`, `h2`: two differently seeded 64-bit hashes of the row.

    The values are hashed as they are, without building the row text first, so typed columns
    need no cast and a separator inside a value cannot be confused with a boundary.
    """
    values = _null_safe(columns)
    return (
        F.xxhash64(*values).alias("h1"),
        F.xxhash64(F.lit("second seed"), *values).alias("h2"),
    )


def field_hash(position: int, column: str, seed: int) -> Column:
    """Hash of one field that depends on its position in the row."""
    return F.xxhash64(F.lit(seed), F.lit(position), *_null_safe([column]))
