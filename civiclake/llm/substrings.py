"""Duplicate passages by relative Lempel-Ziv parsing.

Each document is factored against the reference: all documents with a smaller id. The reference
is indexed in blocks. A block is a run of neighbouring 50-word windows that share their minimizer,
the smallest hash of eight consecutive words in the window; equal windows have equal minimizers,
so equal passages are cut into equal blocks wherever they stand, except at their two ends.

1. Block index: for each block content the smallest document that has it. A document's blocks that
   an earlier document has are copied whole, and the greedy parse joins neighbours into factors.
2. Factor boundaries: where the content goes on differently, a block only partly agrees with
   another of the same minimizer. The windows of those blocks, and only those, are looked up one by
   one in an index of windows.

A factor is never shorter than a window, so all factors are duplicate spans. Nothing is compared in
pairs: copies of one content meet in an aggregate, and a passage that many documents share costs
each of them its two boundary blocks. All hashes of contents are of 64 bits beside a 64-bit
minimizer, those of windows of 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.chunks import byte_values, drop_kept, words
from civiclake.llm.grams import Sequence, signed, word_hashes
from civiclake.sources.scratch import stage

#: Words of a minimizer.
ANCHOR = 8
_PLACE = 1 << 8  # a block's place is its first window times this, plus its number of windows


def parse_blocks(text: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, minimizer and content of each block of a document."""
    if len(text) < window:
        none = np.empty(0, np.int64)
        return none, none, none, none
    first, second = word_hashes(text)
    anchors = Sequence(first).grams(ANCHOR)
    span = window - ANCHOR + 1
    at = np.lib.stride_tricks.sliding_window_view(anchors, span).argmin(axis=1) + np.arange(len(text) - window + 1)
    start = np.flatnonzero(np.diff(at, prepend=-1))
    stop = np.append(start[1:], len(at))
    content = Sequence(second).stretch(start, stop + window - 1)
    return start, stop - start, signed(anchors[at[start]]), signed(content)


def _blocks(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            found = [parse_blocks(words(data), window) for data in byte_values(batch.column("text"))]
            row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            start, count, anchor, content = (np.concatenate(part) for part in zip(*found, strict=True)) if found else ([],) * 4
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor, pa.int64()),
                    pa.array(content, pa.int64()),
                    batch.column("doc").take(row),
                    batch.column("version").take(row),
                    pa.array(np.asarray(start, np.int64) * _PLACE + count, pa.int64()),
                ],
                ["anchor", "content", "doc", "version", "place"],
            )

    return run


def _boundary_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            rows, starts, hashes = [], [], [np.empty((0, 2), np.uint64)]
            for row, (data, places) in enumerate(
                zip(byte_values(batch.column("text")), batch.column("boundary").to_pylist(), strict=True)
            ):
                if places:
                    at = _windows(np.array(places, np.int64))
                    lanes = word_hashes(words(data))
                    hashes.append(np.stack([Sequence(lane).stretch(at, at + window) for lane in lanes], axis=1))
                    starts.append(at)
                    rows.append(np.full(len(at), row))
            row = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            both = signed(np.concatenate(hashes)).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(both[:, 0]),
                    pa.array(both[:, 1]),
                    batch.column("doc").take(row),
                    batch.column("version").take(row),
                    pa.array(np.concatenate(starts) if starts else [], pa.int64()),
                ],
                ["w1", "w2", "doc", "version", "start"],
            )

    return run


def _windows(places: np.ndarray) -> np.ndarray:
    """The windows of blocks, ascending."""
    places = np.unique(places)
    start, count = places // _PLACE, places % _PLACE
    return np.repeat(start - np.append(0, count.cumsum()[:-1]), count) + np.arange(count.sum())


def factors(copied: list[int], windows: list[int], window: int) -> list[tuple[int, int]]:
    """The greedy parse: maximal stretches (start, stop) of words that earlier documents have.

    `copied` are places of blocks, `windows` single windows found at factor boundaries.
    """
    covered = sorted([(p // _PLACE, p // _PLACE + p % _PLACE - 1 + window) for p in copied] + [(w, w + window) for w in windows])
    found: list[tuple[int, int]] = []
    for start, stop in covered:
        if found and start <= found[-1][1]:
            if stop > found[-1][1]:
                found[-1] = (found[-1][0], stop)
        else:
            found.append((start, stop))
    return found


def kept_words(text: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    kept, at = [], 0
    for start, stop in spans:
        kept += text[at:start]
        at = stop
    return kept + text[at:]


def repeated(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """The documents that have words in a window also found in a document with a smaller key.

    Columns: `doc` (the key), `version` (a hash of the text: rows that repeat a key differ in it),
    `text`, `copied` (block places) and `windows` (array of single windows); a row per distinct
    document. Documents with a null key neither lose words nor lend them.
    """
    if not ANCHOR <= window < _PLACE:
        raise ValueError(f"a window has {ANCHOR} to {_PLACE - 1} words")
    source = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text")
    )
    blocks = source.mapInArrow(_blocks(window), "anchor long, content long, doc long, version long, place long")
    # The smallest document of each content; contents that no other document has and whose minimizer
    # stands in no other content are of no further use.
    index = blocks.groupBy("anchor", "content").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    contents = stage(index, "block-index")
    ways = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1").select("anchor", F.lit(True).alias("parts"))
    useful = stage(
        contents.join(ways, "anchor", "left")
        .where("first < last or parts")
        .select("anchor", "content", "first", F.coalesce("parts", F.lit(False)).alias("parts")),
        "useful-blocks",
    )
    marks = (
        blocks.join(useful, ["anchor", "content"])
        .where("first < doc or parts")
        .groupBy("doc", "version")
        .agg(
            F.collect_set(F.when(F.col("first") < F.col("doc"), F.col("place"))).alias("copied"),
            F.collect_set(F.when(F.col("first") >= F.col("doc"), F.col("place"))).alias("boundary"),
        )
    )
    involved = stage(source.join(marks, ["doc", "version"]), "involved")
    single = involved.where(F.size("boundary") > 0).mapInArrow(
        _boundary_windows(window), "w1 long, w2 long, doc long, version long, start long"
    )
    shared = stage(
        single.groupBy("w1", "w2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last"),
        "shared-windows",
    )
    found = (
        single.join(shared, ["w1", "w2"])
        .where("first < doc")
        .groupBy("doc", "version")
        .agg(F.collect_set("start").alias("windows"))
    )
    return (
        involved.drop("boundary")
        .join(found, ["doc", "version"], "left")
        .where((F.size("copied") > 0) | F.col("windows").isNotNull())
        .dropDuplicates(["doc", "version"])
    )


def _edits(window: int, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for data, copied, windows in zip(
                byte_values(batch.column("text")),
                batch.column("copied").to_pylist(),
                batch.column("windows").to_pylist(),
                strict=True,
            ):
                own = words(data)
                left = kept_words(own, factors(copied, windows or [], window))
                removed.append(len(own) - len(left))
                joined = b" ".join(left)
                kept.append(joined.decode("utf-8", "replace") if as_text else hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("version"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc", "version", "n_removed", "kept"],
            )

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [words(data) for data in byte_values(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                batch.column("version"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(t)).hexdigest() for t in texts], pa.string()),
            ],
            ["doc", "version", "n_words", "whole"],
        )


_EDIT = "doc long, version long, n_removed long, kept string"


def dedup_digests(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """`key`, `n_words`, `n_removed`, `kept_sha256` of every row of `docs`.

    Words are what lies between ASCII white space, unchanged. Null and empty texts have no words,
    and texts shorter than a window lose none; the digest is of the kept words joined by blanks.
    Rows with equal keys never take words from each other; repeated rows come back as often.
    A row with a null key keeps all its words. Other columns are ignored; an empty table gives an
    empty result.
    """
    edits = repeated(docs, key=key, text=text, window=window).mapInArrow(_edits(window, False), _EDIT)
    rows = docs.select(
        F.col(key).cast("long").alias("doc"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text")
    ).mapInArrow(_whole, "doc long, version long, n_words long, whole string")
    return rows.join(edits, ["doc", "version"], "left").select(
        F.col("doc").cast(docs.schema[key].dataType).alias(key),
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept", "whole").alias("kept_sha256"),
    )


def dedup_texts(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 50, drop_emptied: bool = False
) -> DataFrame:
    """`docs` with the same columns, the words of duplicate spans removed from `text`.

    A text that loses words is its kept words joined by blanks; all others stay as they are. With
    `drop_emptied`, rows that lose all their words go.
    Edge cases are those of `dedup_digests`.
    """
    edits = repeated(docs, key=key, text=text, window=window).mapInArrow(_edits(window, True), _EDIT).alias("e")
    rows = docs.alias("d")
    same = (F.col(f"d.{key}").cast("long") == F.col("e.doc")) & (F.xxhash64(F.col(f"d.{text}")) == F.col("e.version"))
    changed = F.when(F.col("e.doc").isNotNull(), F.col("e.kept")).otherwise(F.col(f"d.{text}"))
    joined = rows.join(edits, same, "left")
    if drop_emptied:
        joined = joined.where("e.doc is null or e.kept <> ''")
    return joined.select(
        *(changed.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns)
    )


def spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """The duplicate spans themselves: `doc`, `start`, `stop`, in words from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (row, *span)
                for row, (copied, windows) in enumerate(
                    zip(batch.column("copied").to_pylist(), batch.column("windows").to_pylist(), strict=True)
                )
                for span in factors(copied, windows or [], window)
            ]
            row, start, stop = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(stop, pa.int64())],
                ["doc", "start", "stop"],
            )

    return repeated(docs, key=key, text=text, window=window).drop("text").mapInArrow(run, "doc long, start long, stop long")
