"""Packing tokenised documents into sequences of a fixed size.

Documents are encoded where they lie; only their lengths and checksums move. The pieces are dealt
at random to blocks of about `BLOCK` sequences, each small enough for one task, and the number of
blocks grows with the tokens. A block is packed best-fit by falling length and then improved by
local search: documents move, or are exchanged one for one, two for one or one for two, from an
emptier sequence to a fuller one, so that the sum of squared fills rises until sequences are empty.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.chunks import RunValues, byte_values, kept, text_of
from civiclake.sources.scratch import stage

#: Sequences a block fills, about.
BLOCK = 1024


class Ids:
    """The ids of a text as little-endian unsigned 32-bit integers.

    `tokenizer` is a file of the `tokenizers` library. `ranks` and `pattern` may name the same
    vocabulary as a rank file: runs without special strings then take that library, which gives
    the same ids several times faster.
    """

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
            ).encode_ordinary
        self.runs = RunValues(self._run)

    def _run(self, run: str) -> bytes:
        if self.fast and not any(string in run for string in self.special):
            return array("I", self.fast(run)).tobytes()
        return array("I", self.library.encode(run, add_special_tokens=False).ids).tobytes()

    def of(self, text: str) -> bytes:
        return b"".join(self.runs.of(text))


def _ids(tokenizer: str, ranks: str | None, pattern: str | None) -> Ids:
    return kept(("ids", tokenizer, ranks, pattern), lambda: Ids(tokenizer, ranks, pattern))


def pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int = 0,
    size: int = 2048,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document's ids and `end_id`, cut into pieces of at most `size` ids.

    Only documents longer than `size` are cut; all their pieces but the first have `size` ids.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = _ids(tokenizer, ranks, pattern), array("I", [end_id]).tobytes()
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for at, data in enumerate(byte_values(batch.column(1))):
                ids = own.of(text_of(data)) + end
                total = len(ids) // 4
                low, high = 0, total % size or size
                while low < total:
                    row.append(at)
                    piece.append(0 if low == 0 else piece[-1] + 1)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(ids[4 * low : 4 * high]))
                    low, high = high, high + size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(values, pa.int64()) for values in (start, length, crc)),
                ],
                ["key", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        cut, f"key {kind}, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers: items by falling length, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    some = 0  # bit f is set if a bin with f free places exists
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[item]
        fitting = some >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = by_free[free].pop()
            if not by_free[free]:
                some ^= 1 << free
        else:
            free, chosen = size, len(bins)
            bins.append([])
        bins[chosen].append(item)
        left = free - length
        if left:
            by_free[left].append(chosen)
            some |= 1 << left
    return bins


def _choices(items: list[int], lengths: list[int]) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """One item of each length, and one pair of each two lengths."""
    by_length: dict[int, list[int]] = {}
    for item in items:
        by_length.setdefault(lengths[item], []).append(item)
    singles = [(own[0],) for own in by_length.values()]
    pairs = [(a[0], b[0]) for a, b in combinations(singles, 2)]
    pairs += [(own[0], own[1]) for own in by_length.values() if len(own) > 1]
    return singles, pairs


def improve(bins: list[list[int]], lengths: list[int], size: int) -> list[list[int]]:
    """Local search over the bins that are not full; stops when no fewer bins are possible or no
    exchange between the emptiest bins and any fuller one raises the sum of squared fills."""
    fill = [sum(lengths[i] for i in own) for own in bins]
    open_bins = [b for b, f in enumerate(fill) if f < size]
    needed = -(-sum(fill[b] for b in open_bins) // size)
    settled: set[int] = set()
    while len(open_bins) > needed:
        waiting = [b for b in open_bins if b not in settled]
        if not waiting or len(settled) > len(open_bins) - needed:
            break
        donor = min(waiting, key=fill.__getitem__)
        if _drain(donor, open_bins, bins, fill, lengths, size):
            settled.clear()
        else:
            settled.add(donor)
        open_bins = [b for b in open_bins if 0 < fill[b] < size]
        needed = -(-sum(fill[b] for b in open_bins) // size)
    return [own for own in bins if own]


def _exchange(singles, pairs, lengths, free, target) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """What to give to `target`, which has `free` places, and take from it, to fill it best."""
    groups = singles + pairs
    sums = np.array([sum(lengths[i] for i in group) for group in groups])
    fitting = np.flatnonzero(sums <= free)
    if len(fitting):
        return groups[fitting[sums[fitting].argmax()]], ()
    one, two = _choices(target, lengths)
    for given, taken in ((groups, one), (singles, two)):
        if taken:
            gain = sums[: len(given), None] - np.array([sum(lengths[i] for i in group) for group in taken])
            gain[(gain <= 0) | (gain > free)] = 0
            best = int(gain.argmax())
            if gain.flat[best]:
                return given[best // len(taken)], taken[best % len(taken)]
    return None


def _drain(donor, open_bins, bins, fill, lengths, size) -> bool:
    """Exchanges from `donor` with each fuller bin while they help; whether it is empty now."""
    changed = True
    while changed:
        changed = False
        choices = _choices(bins[donor], lengths)
        for target in sorted(open_bins, key=lambda b: -fill[b]):
            free = size - fill[target]
            if target == donor or not free or fill[target] < fill[donor]:
                continue
            if found := _exchange(*choices, lengths, free, bins[target]):
                give, take = found
                moved = sum(lengths[i] for i in give) - sum(lengths[i] for i in take)
                bins[donor] = [i for i in bins[donor] if i not in give] + list(take)
                bins[target] = [i for i in bins[target] if i not in take] + list(give)
                fill[donor] -= moved
                fill[target] += moved
                if not bins[donor]:
                    return True
                changed, choices = True, _choices(bins[donor], lengths)
    return False


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int = 0,
    size: int = 2048,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`key`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset` of every piece.

    The pieces of a sequence follow each other without gaps from offset 0. Null and empty texts
    are one piece, the end id alone. Repeated rows are packed each, null keys too; ties of length
    go by the rows' places. Other columns are ignored; an empty table gives an empty result.
    """
    cut = pieces(docs, tokenizer, ranks=ranks, pattern=pattern, end_id=end_id, size=size, key=key, text=text)
    kept = stage(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    total = kept.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, -(-total // (size * BLOCK)))

    def fill(block: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        lengths = rows["length"].tolist()
        sequence, offset = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for number, items in enumerate(improve(best_fit(lengths, size), lengths, size)):
            at = 0
            for item in items:
                sequence[item], offset[item] = (block[0] << 32) | number, at
                at += lengths[item]
        return rows.drop(columns=["row", "block"]).assign(sequence_id=sequence, offset=offset)

    kind = docs.schema[key].dataType.simpleString()
    return (
        kept.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(
            fill,
            f"key {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
        .withColumnRenamed("key", key)
    )
