"""Vector code compression: product codes by exact integer arithmetic.

Components become integers, a vector is cut into equal parts, and each part is named by the nearest
entry of its position's codebook. Distances need dot products of integers. A float64 matrix product is exact
only below 2^53, so the integers are broken into limbs short enough for that, limb products are
recombined in int64, and the first smallest distance wins.

A codebook has a fixed size, so it travels with the tasks and comes back as sums of fixed size; the
vectors stay where they are read. Sums are integers, so neither the order of tasks nor a repeated task
changes a result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.sources.scratch import stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

#: Rows whose distances are computed at once.
BLOCK = 4096

#: A label is hot if it has at least one in so many of all rows; at most so many labels are.
HOT_SHARE = 1024


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """`values` as float64 arrays of magnitudes below 2^bits: the sum of limb i times 2^(bits * i)."""
    sign, rest, found = np.sign(values), np.abs(values), []
    while not found or rest.any():
        found.append((sign * (rest & ((1 << bits) - 1))).astype(np.float64))
        rest = rest >> bits
    return found


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products of rows of `a` with rows of `b` (int64), exact where they fit int64."""
    bits = (53 - math.ceil(math.log2(max(a.shape[1], 1)))) // 2
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    high = [y.T for y in limbs(b, bits)]
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(high):
            if bits * (i + j) < 64:
                total += (x @ y).astype(np.int64) << (bits * (i + j))
    return total


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of `part` the first nearest row of `book` and the squared distance to it."""
    lengths = (part * part).sum(axis=1)[:, None] + (book * book).sum(axis=1)[None, :]
    apart = lengths - 2 * exact_products(part, book)
    codes = apart.argmin(axis=1)
    return codes, np.take_along_axis(apart, codes[:, None], axis=1)[:, 0]


def integers(column: pa.Array, size: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their components times `scale`, rounded down.

    Those with `size` components, all finite, and so small that no squared distance can leave 64 bits.
    """
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    flat = column.filter(fits).flatten().to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        values = np.floor(np.asarray(flat, dtype=np.float64).reshape(-1, size) * scale)
        good = (np.abs(values) <= math.isqrt(2**61 // size)).all(axis=1)  # false for NaN
    take = fits.to_numpy(zero_copy_only=False).copy()
    take[take] = good
    return take, values[good].astype(np.int64)


def _columns(table: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    return table.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))


def _taking_part(rows: DataFrame, scale: int) -> tuple[DataFrame, int]:
    """The rows with finite vectors of the most frequent length, and that length."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0)).where(finite)
    sizes = good.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    largest = math.isqrt(2**61 // max(size, 1))
    small = F.forall("vector", lambda x: F.abs(x) * scale < largest)
    return good.where(F.size("vector") == size).where(small), size


def _parts(values: np.ndarray, parts: int) -> list[np.ndarray]:
    """Equal consecutive parts; a length that `parts` does not divide is filled with zeros."""
    missing = -values.shape[1] % parts
    return np.split(np.pad(values, ((0, 0), (0, missing))), parts, axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], size: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(start, BLOCK)
            take, values = integers(rows.column("vector"), size, scale)
            if len(values):
                yield rows.filter(pa.array(take)), values


def _sums(rows: DataFrame, books: list[np.ndarray], size: int, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each part position: the rows each entry is nearest to, and their component sums."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros_like(b) for b in books]
        for _, values in _blocks(batches, size, scale):
            for p, part in enumerate(_parts(values, len(books))):
                codes, _ = nearest(part, books[p])
                counts[p] += np.bincount(codes, minlength=len(books[p]))
                np.add.at(sums[p], codes, part)
        cells = np.concatenate([np.column_stack([c, s]).ravel() for c, s in zip(counts, sums, strict=True)])
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(used, pa.int64()), "total": pa.array(cells[used], pa.int64())})

    cells = np.zeros(sum(b.shape[0] * (b.shape[1] + 1) for b in books), dtype=np.int64)
    for r in rows.select("vector").mapInArrow(gather, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total")).collect():
        cells[r["cell"]] = r["total"]
    found, start = [], 0
    for book in books:
        end = start + book.shape[0] * (book.shape[1] + 1)
        block = cells[start:end].reshape(book.shape[0], -1)
        found.append((block[:, 0], block[:, 1:]))
        start = end
    return found


def train(rows: DataFrame, size: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list[np.ndarray]:
    """The codebooks: first the parts of the `entries` smallest ids, then `rounds` times the floored means of what is nearest.

    What reaches the driver is the first entries and, each round, a sum for every component of every entry.
    """
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector", F.asc_nulls_last("label")).select("vector").limit(entries).collect()
    if not first:
        return []
    _, values = integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), size, scale)
    books = _parts(values, parts)
    for _ in range(rounds):
        books = [
            np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], book)
            for book, (count, total) in zip(books, _sums(rows, books, size, scale), strict=True)
        ]
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """`vec_id`, `code`, `error`, `label_error`, `codebooks_sha256` of every row that takes part.

    Left out: vectors that are null or empty, hold null or non-finite components, have another length than most (of
    equally frequent lengths the longest counts), or hold a component whose square times 4 and the length leaves 63 bits.
    Rows that repeat an id are rows of their own; among the first entries they are ordered by vector, then label. Null ids
    take part and come last there. With fewer rows than entries the codebooks are shorter. Two hex digits name an entry, so there can be 256.
    """
    rows, size = _taking_part(_columns(table, key, label, vector), scale)
    books = train(rows, size, parts, entries, rounds, scale)
    name = digest(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, values in _blocks(batches, size, scale):
            found = [nearest(part, book) for part, book in zip(_parts(values, len(books)), books, strict=True)]
            digits = np.column_stack([codes for codes, _ in found]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [kept.column("vec_id"), kept.column("label"), pa.array([d.tobytes().hex() for d in digits], pa.string()), pa.array(sum(e for _, e in found), pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    kind = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("label", rows.schema["label"].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    coded = stage(rows.mapInArrow(encode, kind), "vector-codes")
    return _with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(name).alias("codebooks_sha256"))


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """Each row with the errors summed over its label, null labels together.

    The few hot labels are broadcast (at most HOT_SHARE by their share of the rows), all others joined by a shuffle.
    """
    totals = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    rows = coded.count()
    hot = (F.col("n") * HOT_SHARE >= rows) | F.col("label").isNull()
    many = totals.where(hot).select(F.col("label").alias("of"), F.col("label_error").alias("hot_error"))
    marked = coded.join(F.broadcast(many), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    rest = marked.where("hot_error is null").drop("hot_error").join(totals.where(~hot).select("label", "label_error"), "label")
    return marked.where("hot_error is not null").withColumnRenamed("hot_error", "label_error").unionByName(rest)
