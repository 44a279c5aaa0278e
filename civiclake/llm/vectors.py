"""What the vector operators share: which vectors take part, and their NumPy form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """`vec_id`, `vector` (doubles) of the rows that take part, one per key.

    Left out: null keys, vectors that are null, empty, zero or hold null or non-finite components,
    and vectors of another length than the most frequent one (of equally frequent ones, the longest).
    A key that occurs with several vectors has the least of them.
    """
    value = F.col(vector).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = (
        table.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
        .select(F.col(key).cast("long").alias("vec_id"), value.alias("vector"))
        .where(finite)
        .where(F.exists("vector", lambda x: x != 0))
    )
    sizes = good.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return good.where(F.size("vector") == (sizes["size"] if sizes else 0)).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A row per vector; all have the same length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(flat):
        return np.empty((0, 0))
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(flat), -1)
