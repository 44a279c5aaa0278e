"""Order-free digests of ranges of rows: what two releases share is found without moving it.

A range is everything of one entity, or the rows of an entity whose fingerprints start with the same
bits. Its digest is a set of sums over fingerprints, so it does not depend on order, and map-side
combining reduces a range to one row a task. Equal digests prove a range unchanged, copies included; only
rows of ranges that differ go on to the next, finer level.

What a level hands to the next is a bitmap over the hashes of ranges: 128 bits for each, but never more
than 2^27, so it takes 16 MB at most and may be broadcast. Two ranges that share a bit only cost work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.fingerprint import row_fingerprint
from civiclake.sources.scratch import stage

#: The largest bitmap, and the pieces it comes in, as powers of two: 2^27 bits are 4096 pieces of 32768.
RANGE_BITS = 27
_PIECE_BITS = 15

#: Bits for each hash in a bitmap below that size, as a power of two.
_ROOM = 7

#: Leading fingerprint bits that name a range within an entity, level by level.
LEVELS = (0, 12, 24)

#: Lengths of the pieces a 64-bit hash is summed in: sums of 22 bits stay exact for 2^41 rows.
_LIMBS = (22, 21, 21)


def _limbs(hash_: str) -> list[Column]:
    found, start = [], 0
    for bits in _LIMBS:
        found.append(F.shiftrightunsigned(hash_, start).bitwiseAND(F.lit((1 << bits) - 1)))
        start += bits
    return found


def release_prints(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), entity: Sequence[str] = ()) -> DataFrame:
    """The narrow form of a release: `h1`, `h2`, `by`, and `entity_hash` over `by` and `entity`."""
    owner = [part for c in (*by, *entity) for part in (F.isnull(c), F.col(c))]
    return df.select(*row_fingerprint(columns), *by, F.xxhash64(F.lit(0), *owner).alias("entity_hash"))


def range_hash(bits: int) -> Column:
    """The hash of the range a print lies in: its entity, and the first `bits` bits of its fingerprint."""
    if bits == 0:
        return F.col("entity_hash")
    return F.xxhash64("entity_hash", F.shiftrightunsigned("h1", 64 - bits))


def range_digests(prints: DataFrame, bits: int) -> DataFrame:
    """`range`, `rows`, `differs` of every range: do its rows before (`weight` -1) and after (`weight` 1) make different bags."""
    sums = [F.sum(F.col("weight") * limb) for h in ("h1", "h2") for limb in _limbs(h)]
    differs = reduce(lambda a, b: a | b, [s != 0 for s in sums], F.sum("weight") != 0)
    return prints.groupBy(range_hash(bits).alias("range")).agg(F.count(F.lit(1)).alias("rows"), differs.alias("differs"))


@dataclass(frozen=True)
class Bitmap:
    """Rows `piece`, `words` (4 KB), at most 4096 of them, and the number of leading hash bits they index."""

    pieces: DataFrame
    bits: int


def bitmap_of(hashes: DataFrame, column: str, at_most: int | None = None) -> Bitmap:
    """The bitmap of a column of hashes, of which there are `at_most` so many (counted if that is not known)."""
    rows = hashes.count() if at_most is None else at_most
    bits = min(max(math.ceil(math.log2(max(rows, 1))) + _ROOM, _PIECE_BITS), RANGE_BITS)
    place = F.shiftrightunsigned(column, 64 - bits)
    pieces = hashes.groupBy(F.shiftright(place, _PIECE_BITS).alias("piece")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << _PIECE_BITS) - 1))).alias("bytes")
    )
    eight = lambda i: F.conv(F.hex(F.substring("bytes", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    words = F.transform(F.sequence(F.lit(0), F.lit((1 << _PIECE_BITS) // 64 - 1)), eight)
    return Bitmap(pieces.select("piece", words.alias("words")), bits)


def within(df: DataFrame, hash_: Column, bitmap: Bitmap) -> DataFrame:
    """The rows whose hash has its bit in the bitmap: a filter where the rows are read."""
    place = F.shiftrightunsigned(hash_, 64 - bitmap.bits)
    inner = place.bitwiseAND(F.lit((1 << _PIECE_BITS) - 1))
    # Bytes of a word are read with the first one highest.
    bit = (F.lit(56) - inner.bitwiseAND(F.lit(56)) + inner.bitwiseAND(F.lit(7))).cast("int")
    rows = df.withColumns({"_piece": F.shiftright(place, _PIECE_BITS), "_word": F.shiftright(inner, 6).cast("int"), "_bit": bit})
    set_ = (F.col("_piece") == F.col("piece")) & (F.getbit(F.get("words", F.col("_word")), F.col("_bit")) == 1)
    # Pieces are unique, so an inner join keeps each row once. A semi join would be pushed below the projection
    # that makes the hash, and compute it three times for every row.
    return rows.join(F.broadcast(bitmap.pieces), set_).select(*df.columns)


def changed_prints(before: DataFrame, after: DataFrame) -> DataFrame:
    """The prints of both releases with `weight` -1 and 1, without those of ranges proved unchanged.

    The levels end early where half of the rows or more lie in ranges that differ: finer ranges of such
    releases seldom agree; and less than a tenth is not worth a filter. That decides how much is
    pruned, never what is found.
    """
    narrow = before.withColumn("weight", F.lit(-1)).unionByName(after.withColumn("weight", F.lit(1)))
    prints = stage(narrow, "release-prints")
    for bits in LEVELS:
        found = stage(range_digests(prints, bits), "range-digests")
        counts = F.struct(F.sum("rows").alias("rows"), F.sum(F.when(F.col("differs"), F.col("rows"))).alias("left"), F.count_if("differs").alias("ranges"))
        total = found.agg(counts.alias("of")).first()["of"]
        left, rows = total["left"] or 0, total["rows"] or 0
        if left * 10 < rows * 9:
            prints = within(prints, range_hash(bits), bitmap_of(found.where("differs"), "range", total["ranges"]))
        if left * 2 >= rows:
            break
    return prints
