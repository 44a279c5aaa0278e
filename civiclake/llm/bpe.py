"""Byte-level BPE, encoding and decoding, with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary answers pre-tokens that are vocabulary
entries as a whole. Tier two: the bytes of any other pre-token form a linked list, a heap holds
the adjacent pairs that can merge, and the lowest rank (then the leftmost place) merges first.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from civiclake.llm.chunks import RunValues, byte_values, text_of

#: Different pre-tokens whose ids a worker keeps, and their longest.
KEPT_PIECES = 500_000
KEPT_LENGTH = 48

_ALL = (1 << 64) - 1
_MIX = 0x9E3779B97F4A7C15


class PerfectHash:
    """Keys to 0..n-1 without gaps: hash and displace, keys of one bucket moved together.

    Buckets are placed by falling size. A bucket of several keys tries displacements until all
    its keys fall on free places; a bucket of one key takes any free place, kept as its negative.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 4)
        self.displacement = [0] * self.buckets
        self.keys: list[bytes] = [b""] * n
        self.values = [0] * n
        hashes = [xxhash.xxh3_64_intdigest(key) for key in keys]
        if len(set(hashes)) < n:
            raise ValueError("keys repeat")
        members: dict[int, list[int]] = {}
        for index, h in enumerate(hashes):
            members.setdefault(h % self.buckets, []).append(index)
        free = np.ones(n, bool)
        singles = []
        for bucket, own in sorted(members.items(), key=lambda item: -len(item[1])):
            if len(own) == 1:
                singles.append((bucket, own[0]))
                continue
            parts = np.array([hashes[i] for i in own], dtype=np.uint64)
            for start in itertools.count(0, 256):
                tried = np.arange(start, start + 256, dtype=np.uint64)[:, None]
                mixed = (parts ^ (tried * np.uint64(_MIX))) * np.uint64(_MIX)
                places = ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(n)).astype(np.int64)
                good = free[places].all(axis=1) & (np.diff(np.sort(places, axis=1), axis=1) > 0).all(axis=1)
                if good.any():
                    chosen = int(good.argmax())
                    break
            self.displacement[bucket] = start + chosen
            free[places[chosen]] = False
            for index, place in zip(own, places[chosen].tolist(), strict=True):
                self.keys[place], self.values[place] = keys[index], index
        for (bucket, index), place in zip(singles, np.flatnonzero(free).tolist(), strict=True):
            self.displacement[bucket] = -place - 1
            self.keys[place], self.values[place] = keys[index], index

    def find(self, key: bytes) -> int:
        """The position of `key` in the list it was built from, or -1."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        moved = self.displacement[h % self.buckets]
        if moved < 0:
            place = -moved - 1
        else:
            mixed = ((h ^ (moved * _MIX & _ALL)) * _MIX) & _ALL
            place = (mixed ^ (mixed >> 29)) % self.n
        return self.values[place] if self.keys[place] == key else -1


class PieceIds(dict):
    """The ids of pre-tokens, kept for short ones and emptied when full: runs differ by a comma or a line end."""

    def __init__(self, encode: Callable[[bytes], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece.encode())
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes by a rank file: a line has a token in Base64 and its rank."""

    def __init__(self, path: str, pattern: str):
        ranks: dict[bytes, int] = {}
        with open(path, "rb") as file:
            for line in file.read().splitlines():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.rank_of = list(ranks.values())
        self.whole = PerfectHash(list(ranks))
        self.bytes = [ranks.get(bytes([b]), -1) for b in range(256)]
        if min(self.bytes) < 0:
            raise ValueError("the vocabulary lacks a single byte")
        self.pairs = {
            (ranks[token[:cut]] << 32) | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self.pre_tokens = regex.compile(pattern).findall
        self.pieces = PieceIds(self._piece)
        self.runs = RunValues(self._run)

    def _piece(self, data: bytes) -> bytes:
        found = self.whole.find(data)
        return array("I", (self.rank_of[found],) if found >= 0 else self.merge(data)).tobytes()

    def _run(self, run: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pre_tokens(run)))

    def merge(self, data: bytes) -> list[int]:
        """The tokens of one pre-token, from its single bytes up.

        `pending` has the heap's entry of each place that may still merge with what follows it; other
        entries of the place are out of date.
        """
        size, pair = len(data), self.pairs.get
        single = self.bytes
        ids = [single[b] for b in data]
        right, left = list(range(1, size + 1)), list(range(-1, size - 1))
        pending = [-1] * size
        heap = []
        for at in range(size - 1):
            if (rank := pair((ids[at] << 32) | ids[at + 1])) is not None:
                pending[at] = entry = rank * size + at
                heap.append(entry)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            rank, at = divmod(entry, size)
            if pending[at] != entry:
                continue  # one of the two has merged with another meanwhile
            after = right[at]
            beyond = right[at] = right[after]
            ids[at], ids[after] = rank, -1
            pending[at] = pending[after] = -1
            if beyond < size:
                left[beyond] = at
                if (r := pair((rank << 32) | ids[beyond])) is not None:
                    pending[at] = entry = r * size + at
                    heappush(heap, entry)
            before = left[at]
            if before >= 0:
                if (r := pair((ids[before] << 32) | rank)) is not None:
                    pending[before] = entry = r * size + before
                    heappush(heap, entry)
                else:
                    pending[before] = -1
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(self.runs.of(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """Built once per worker."""
    return Codec(path, pattern)


def encode(docs: DataFrame, ranks: str, pattern: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `ids` (binary: little-endian unsigned 32-bit) of every row of `docs`.

    `ranks` is the path of the rank file, `pattern` splits a text into pre-tokens; a pre-token
    may start with a blank but have none inside (see `chunks`). Null and empty texts have no ids.
    Texts of any length are encoded whole. Repeated rows and null keys stay as they are; other
    columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            ids = [own.encode(text_of(data)) for data in byte_values(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        run, f"key {kind}, ids binary"
    ).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: str, pattern: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`key`, `decoded` (binary) of rows that `encode` made; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            data = [own.decode(value or b"") for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["key", "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(encoded[key].alias("key"), encoded[ids].alias("ids")).mapInArrow(
        run, f"key {kind}, decoded binary"
    ).withColumnRenamed("key", key)


def round_trip(docs: DataFrame, ranks: str, pattern: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_tokens`, `ids_sha256`, `decoded_sha256` of every row, encoded and decoded in one pass.

    The decoded bytes come from the ids alone. Edge cases are those of `encode`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            counts, names, decoded = [], [], []
            for data in byte_values(batch.column(1)):
                ids = own.encode(text_of(data))
                counts.append(len(ids) // 4)
                names.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(decoded, pa.string())],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ).withColumnRenamed("key", key)
