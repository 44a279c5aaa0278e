"""Toxic spans by a linear-chain conditional random field with two tags.

Training, from document labels alone:

1. Cues. A word and its prefixes are cues, known by 64-bit hashes; each cue's documents are counted by
   label. Its log odds are drawn towards zero by their uncertainty and kept if it stands in at least
   `MIN_DOCS` documents. Of more than `LABELLED` labelled documents about that many teach, those with
   the smallest hashes, so what is kept of them is bounded without a limit of its own.
2. Token labels. A token of a toxic document is toxic if its strongest cue has log odds of at least
   `SURE`; all other tokens are not. Documents that fit what follows are read with log odds from
   the other folds, so that a document's own words do not speak for its label.
3. The field. A token is described by the classes of its strongest and weakest cue and those of its
   neighbours. Weights and transitions maximise the penalised likelihood of the labelled tokens of
   at most `FIT_DOCS` different whole documents of each label, those with the smallest hashes.
4. Document score. Forward-backward gives each token's probability of being toxic; a logistic curve
   over the expected number of toxic tokens, their share and the highest marginal is fitted on the
   same whole documents.

Scoring is one pass over the texts. Chains are cut into lanes of equal length and the two-by-two
matrices of all lanes advance together, so a long document costs what many short ones do.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.llm.chunks import byte_values, drop_kept, kept, words
from civiclake.operators.digests import bitmap_of, within
from civiclake.sources.scratch import stage

#: Labelled documents that teach, about, if there are more.
LABELLED = 100_000
#: Documents a cue must stand in.
MIN_DOCS = 4
#: Parts of the labelled documents; what describes a document of one part comes from the others.
FOLDS = 3
#: Standard errors by which log odds are drawn towards zero.
DOUBT = 1.3
#: Log odds from which a token of a toxic document is labelled toxic.
SURE = 1.0
#: Labelled documents of each label, at most, that fit the field and the curve.
FIT_DOCS = {0: 1500, 1: 750}
#: Tokens whose marginals are computed at once while fitting, about (whole documents).
FIT_PORTION = 400_000
#: Lengths of the prefixes, in bytes, that are cues beside the whole word.
PREFIXES = (4, 5, 6, 7)
_EDGES = np.array([-2.0, -1.0, -0.5, -0.1, 0.1, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.5])
CLASSES = len(_EDGES) + 2  # one for tokens without any cue


def cues(word: bytes) -> list[bytes]:
    """The whole word, marked by an end, and its beginnings."""
    core = word.strip(b".,;:!?()[]\"'|*%&$#-_")
    if len(core) >= PREFIXES[-1]:
        return [core + b"\0", *[core[:n] for n in PREFIXES]]
    return [core + b"\0", *[core[:n] for n in PREFIXES if len(core) >= n]]


def cue_hashes(word: bytes) -> list[int]:
    """The cues as signed 64-bit numbers."""
    return [h - (h >> 63 << 64) for h in map(xxhash.xxh64_intdigest, cues(word))]


class _CueHashes(dict):
    """The cues of the words a task has met, as the bytes of 64-bit integers, emptied when full."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= 200_000:
            self.clear()
        found = np.array(cue_hashes(word), np.int64).tobytes()
        if len(word) <= 64:
            self[word] = found
        return found


#: Cues a task holds before it hands on their counts.
HELD_CUES = 1_000_000

#: Counters of a cue: its documents by part and label.
_COUNTERS = [f"n{fold}{label}" for fold in range(FOLDS) for label in (0, 1)]


def _cue_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of each part and label have a cue, summed over up to `HELD_CUES` cues."""
    drop_kept()
    known, found, codes, held = _CueHashes(), [], [], 0

    def counts() -> pa.RecordBatch:
        hashes, inverse = np.unique(np.concatenate(found), return_inverse=True)
        code = np.repeat(np.array(codes, np.int8), [len(f) for f in found])
        columns = [np.bincount(inverse[code == c], minlength=len(hashes)) for c in range(len(_COUNTERS))]
        return pa.RecordBatch.from_arrays([pa.array(hashes), *map(pa.array, columns)], ["cue", *_COUNTERS])

    for batch in batches:
        for data, toxic, fold in zip(byte_values(batch.column("text")), batch.column("toxic").to_pylist(), batch.column("fold").to_pylist(), strict=True):
            own = np.unique(np.frombuffer(b"".join(map(known.__getitem__, set(words(data.lower() if data else None)))), np.int64))
            found.append(own)
            codes.append(2 * fold + toxic)
            held += len(own)
            if held >= HELD_CUES:
                yield counts()
                found, codes, held = [], [], 0
    if found:
        yield counts()


@dataclass
class Odds:
    """Hashes of cues, and the classes of their log odds: from all documents, then without each fold."""

    cues: np.ndarray
    classes: np.ndarray


#: What a word says in one byte: the class of its strongest cue, times CLASSES, and that of its weakest.
UNKNOWN = CLASSES * CLASSES - 1


class Lexicon(dict):
    """The bytes of words by the log odds of their cues, kept per worker; `which` of the odds holds here."""

    def __init__(self, odds: Odds, which: int = 0, limit: int = 500_000):
        super().__init__()
        self.known = dict(zip(odds.cues.astype(np.uint64).tolist(), odds.classes[:, which].tolist(), strict=True))
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        known = self.known
        found = [known[cue] for cue in map(xxhash.xxh64_intdigest, cues(word)) if cue in known]
        code = max(found) * CLASSES + min(found) if found else UNKNOWN
        if len(self) >= self.limit:
            self.clear()
        if len(word) <= 64:
            self[word] = code
        return code

    def codes(self, own: list[bytes]) -> np.ndarray:
        return np.frombuffer(bytes(map(self.__getitem__, own)), np.uint8)

    def classes(self, own: list[bytes]) -> np.ndarray:
        """Two rows: the class of the strongest and of the weakest cue of each word."""
        return np.stack(np.divmod(self.codes(own).astype(np.int64), CLASSES))


def emissions(codes: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The summed weights of the tokens' features, from the bytes of their words."""
    wide = CLASSES + 1
    strong, weak = np.divmod(np.arange(UNKNOWN + 1), CLASSES)
    own, before, after = weights[strong] + weights[wide + weak], weights[2 * wide + strong], weights[3 * wide + strong]
    none_before, none_after = weights[2 * wide + CLASSES], weights[3 * wide + CLASSES]
    found = own[codes]
    found[1:] += np.where(first[1:], none_before, before[codes[:-1]])
    found[:-1] += np.where(first[1:], none_after, after[codes[1:]])
    found[0] += none_before
    found[-1] += none_after
    return found


def features(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Four feature numbers per token: own strongest, own weakest, previous and next strongest.

    `first` marks the first tokens of documents, beyond which there are no neighbours.
    """
    n = classes.shape[1]
    before, after = np.full(n, CLASSES), np.full(n, CLASSES)
    before[1:] = np.where(first[1:], CLASSES, classes[0, :-1])
    after[:-1] = np.where(first[1:], CLASSES, classes[0, 1:])
    wide = CLASSES + 1
    return np.stack([classes[0], wide + classes[1], 2 * wide + before, 3 * wide + after])


FEATURES = 4 * (CLASSES + 1)


@dataclass
class Field:
    """Weights of the toxic tag, log potentials of tag pairs, of the first tag, and the curve."""

    odds: Odds
    weights: np.ndarray
    pairs: np.ndarray
    start: np.ndarray
    curve: np.ndarray
    centre: np.ndarray
    scale: np.ndarray


#: Emissions beyond this are as good as certain; their exponentials stay finite.
_CERTAIN = 200.0


def marginals(
    emission: np.ndarray, first: np.ndarray, pairs: np.ndarray, start: np.ndarray, with_pairs: bool = True
) -> tuple[np.ndarray, np.ndarray | None, float]:
    """Probability of the toxic tag and of each tag pair (four columns, from the previous token; of no
    meaning at first tokens), and the summed log partition functions of all documents.

    With two tags the forward and the backward vector are one ratio each, toxic over not. Token t turns the
    ratio r into E (p01 + p11 r) / (p00 + p10 r), E being its exponential emission; at a document's first token
    it is E s1 / s0, whatever came before. Lanes learn the ratio they start with from the products of the
    lanes before them.
    """
    n = len(emission)
    lanes = max(1, int(np.sqrt(n)))
    length = -(-n // lanes)
    e, f = np.zeros(lanes * length), np.ones(lanes * length, bool)
    e[:n], f[:n] = np.clip(emission, -_CERTAIN, _CERTAIN), first
    steps, begins = (x.reshape(lanes, length).T.copy() for x in (np.exp(e), f))
    some = begins.any(axis=1)
    (p00, p01), (p10, p11) = np.exp(pairs)
    s0, s1 = np.exp(start)

    # Products of the lanes' steps: a, b lead from the clean tag, c, d from the toxic one.
    a, b, c, d = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(length):
        own, here = steps[t], begins[t]
        new = [a * p00 + b * p10, (a * p01 + b * p11) * own, c * p00 + d * p10, (c * p01 + d * p11) * own]
        if some[t]:
            for i, total in ((0, a + b), (2, c + d)):
                new[i], new[i + 1] = np.where(here, total * s0, new[i]), np.where(here, total * s1 * own, new[i + 1])
        scale = 1 / (new[0] + new[1] + new[2] + new[3])
        a, b, c, d = (x * scale for x in new)
    left, right = np.empty(lanes), np.empty(lanes)
    clean, toxic, tiny = 0.5, 0.5, 1e-300
    product = list(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True))
    for lane, (a, b, c, d) in enumerate(product):
        left[lane] = toxic / max(clean, tiny)
        clean, toxic = clean * a + toxic * c, clean * b + toxic * d
        clean, toxic = clean / (clean + toxic), toxic / (clean + toxic)
    clean, toxic = 0.5, 0.5
    for lane, (a, b, c, d) in zip(range(lanes - 1, -1, -1), reversed(product), strict=True):
        right[lane] = toxic / max(clean, tiny)
        clean, toxic = a * clean + b * toxic, c * clean + d * toxic
        clean, toxic = clean / (clean + toxic), toxic / (clean + toxic)

    before, ratio, after = np.empty_like(steps), np.empty_like(steps), np.empty_like(steps)
    r = left
    for t in range(length):
        before[t] = r
        r = steps[t] * (p01 + p11 * r) / (p00 + p10 * r)
        if some[t]:
            r = np.where(begins[t], steps[t] * (s1 / s0), r)
        ratio[t] = r
    r = right
    for t in range(length - 1, -1, -1):
        after[t] = r
        r = steps[t] * r
        r = (p10 + p11 * r) / (p00 + p01 * r)
        if some[t]:
            r = np.where(begins[t], 1.0, r)
    steps, before, ratio, after = (x.T.reshape(-1)[:n] for x in (steps, before, ratio, after))
    odds = ratio * after
    last = np.append(first[1:], True)
    log_z = np.log(p00 + p10 * before[~first]).sum() + first.sum() * float(start[0]) + np.log1p(ratio[last]).sum()
    both = None
    if with_pairs:
        both = np.empty((n, 4))
        both[:, 0], both[:, 1], both[:, 2], both[:, 3] = p00, p01 * steps * after, before * p10, before * p11 * steps * after
        both /= both.sum(axis=1, keepdims=True)
    return odds / (1 + odds), both, float(log_z)


def _fit_portions(chains: list[np.ndarray], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and first tokens of about `size` tokens of whole documents at a time."""
    portion, total = [], 0
    for number, own in enumerate(chains, 1):
        portion.append(own)
        total += own.shape[1]
        if total >= size or number == len(chains):
            first = np.zeros(total, bool)
            first[np.cumsum([0, *(c.shape[1] for c in portion[:-1])])] = True
            yield features(np.concatenate(portion, axis=1).astype(np.int64), first), first
            portion, total = [], 0


def _fit_field(chains: list[np.ndarray], tags: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Penalised maximum likelihood by gradient steps with momentum and per-weight scaling.

    `chains` are the classes of each document's tokens, `tags` those of all documents in a row.
    """
    x = np.zeros(FEATURES + 6)
    square, mean = np.zeros_like(x), np.zeros_like(x)
    n, seen = len(tags), np.zeros_like(x)
    at = 0
    for feats, first in _fit_portions(chains, FIT_PORTION):
        own = tags[at : at + len(first)].astype(np.int64)
        inner = np.flatnonzero(~first)
        seen[:FEATURES] += np.bincount(feats[:, own == 1].ravel(), minlength=FEATURES)
        seen[FEATURES : FEATURES + 4] += np.bincount(2 * own[inner - 1] + own[inner], minlength=4)
        seen[FEATURES + 4 :] += np.bincount(own[first], minlength=2)
        at += len(first)
    for step in range(1, rounds + 1):
        weights, pairs, start = x[:FEATURES], x[FEATURES : FEATURES + 4].reshape(2, 2), x[FEATURES + 4 :]
        expected = np.zeros_like(x)
        for feats, first in _fit_portions(chains, FIT_PORTION):
            toxic, both, _ = marginals(weights[feats].sum(axis=0), first, pairs, start)
            expected[:FEATURES] += np.bincount(feats.ravel(), np.tile(toxic, 4), FEATURES)
            expected[FEATURES : FEATURES + 4] += both[~first].sum(axis=0)
            expected[FEATURES + 4 :] += (1 - toxic[first]).sum(), toxic[first].sum()
        gradient = (seen - expected) / n - 1e-6 * x
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        x = x + 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return x[:FEATURES], x[FEATURES : FEATURES + 4].reshape(2, 2), x[FEATURES + 4 :]


def summaries(toxic: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document: log of the expected toxic tokens, log of their share, logit of the highest
    marginal, log of what the others add to it."""
    at = np.flatnonzero(first)
    expected = np.add.reduceat(toxic, at)
    highest = np.clip(np.maximum.reduceat(toxic, at), 1e-6, 1 - 1e-6)
    size = np.diff(np.append(at, len(toxic)))
    others = np.maximum(expected - highest, 0)
    return np.stack(
        [np.log(expected + 1e-2), np.log(expected / size + 1e-4), np.log(highest / (1 - highest)), np.log(others + 1e-2)], axis=1
    )


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression with a small ridge, by Newton steps, on centred columns."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    curve = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ curve, -30, 30)))
        ridge = np.diag([1e-6] + [0.05] * x.shape[1])
        curve = curve + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ curve)
    return curve, centre, scale


def fitting_rows(rows: DataFrame) -> DataFrame:
    """Of each label at most `FIT_DOCS` different texts, whole: those with the smallest hashes."""
    spark = rows.sparkSession
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    chosen = [
        hashed.where(F.col("toxic") == label).select("toxic", "hash").distinct().orderBy("hash").limit(n) for label, n in FIT_DOCS.items()
    ]
    few = spark.createDataFrame(chosen[0].union(chosen[1]).collect(), "toxic long, hash long")  # FIT_DOCS rows
    return hashed.join(F.broadcast(few), ["toxic", "hash"], "left_semi").drop("hash").dropDuplicates(["text", "toxic"])


def train(labelled: DataFrame) -> Field:
    """Fit on rows `text`, `toxic` (0 or 1). Rows with a null text or label teach nothing.

    What reaches the driver is the counts and cues of at most about `LABELLED` documents, and the fitting ones. Without documents of both labels the field has no cues and all scores are the share of toxic ones.
    """
    rows = stage(
        labelled.where(F.col("text").isNotNull() & F.col("toxic").isin(0, 1)).select(
            "text", F.col("toxic").cast("long").alias("toxic"), F.pmod(F.xxhash64("text"), F.lit(FOLDS)).alias("fold")
        ),
        "labelled",
    )
    if (share := LABELLED / max(rows.count(), 1)) < 1:
        rows = rows.where(F.xxhash64(F.lit("teaches"), "text") < int(share * 2**64) - 2**63)
    totals = {(r["fold"], r["toxic"]): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    bad, good = (sum(n for (_, label), n in totals.items() if label == which) for which in (1, 0))
    flat = Field(Odds(np.empty(0, np.int64), np.empty((0, 1 + FOLDS), np.uint8)), np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2), np.zeros(5), np.zeros(4), np.ones(4))
    if not bad or not good:
        flat.curve[0] = 6.0 if bad else -6.0
        return flat

    def log_odds(left_out: int | None):
        """Of a cue, from the documents outside one fold."""
        a, b = (sum((F.col(f"n{fold}{label}") for fold in range(FOLDS) if fold != left_out), F.lit(0.5)) for label in (1, 0))
        n_bad, n_good = (bad, good) if left_out is None else (bad - totals.get((left_out, 1), 0), good - totals.get((left_out, 0), 0))
        plain = F.log(a / (n_bad + 1)) - F.log(b / (n_good + 1))
        return F.signum(plain) * F.greatest(F.abs(plain) - DOUBT * F.sqrt(1 / a + 1 / b), F.lit(0.0))

    table = (
        rows.mapInArrow(_cue_counts, ", ".join(f"{c} long" for c in ("cue", *_COUNTERS)))
        .groupBy("cue")
        .agg(*(F.sum(c).alias(c) for c in _COUNTERS))
        .where(sum((F.col(c) for c in _COUNTERS), F.lit(0)) >= MIN_DOCS)
        .select("cue", *(log_odds(fold).alias(f"odds{i}") for i, fold in enumerate([None, *range(FOLDS)])))
        .where("odds0 <> 0")
        .toArrow()
    )
    odds = Odds(table["cue"].to_numpy(), np.column_stack([np.searchsorted(_EDGES, table[f"odds{i}"].to_numpy()) for i in range(1 + FOLDS)]).astype(np.uint8))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        own = [Lexicon(odds, fold + 1) for fold in range(FOLDS)]
        for batch in batches:
            found = [
                own[fold].classes(words(data.lower())).astype(np.uint8).tobytes()
                for data, fold in zip(byte_values(batch.column("text")), batch.column("fold").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column("toxic")], ["classes", "toxic"])

    sample = fitting_rows(rows).mapInArrow(describe, "classes binary, toxic long").collect()
    chains, tags, labels = [], [], []
    sure = int(np.searchsorted(_EDGES, SURE))
    for row in sample:
        own = np.frombuffer(row.classes, np.uint8).reshape(2, -1)
        if not own.shape[1]:
            continue
        chains.append(own)
        tags.append(((own[0] >= sure) & (own[0] < CLASSES - 1)).astype(np.uint8) * np.uint8(row.toxic))
        labels.append(row.toxic)
    if len(set(labels)) < 2:
        flat.curve[0] = np.log((bad + 0.5) / (good + 0.5))
        return flat
    weights, pairs, start = _fit_field(chains, np.concatenate(tags))
    x = [
        summaries(marginals(weights[feats].sum(axis=0), first, pairs, start)[0], first)
        for feats, first in _fit_portions(chains, FIT_PORTION)
    ]
    curve, centre, scale = _fit_curve(np.concatenate(x), np.array(labels, float))
    return Field(odds, weights, pairs, start, curve, centre, scale)


def _tagged(field: Field, lexicon: Lexicon, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all tokens of some documents, and where each document starts. A document
    without words counts as one unknown token."""
    split = [words(data.lower() if data else None) or [b""] for data in texts]
    first = np.zeros(sum(map(len, split)), bool)
    first[np.cumsum([0, *map(len, split[:-1])])] = True
    codes = lexicon.codes([word for own in split for word in own])
    toxic, _, _ = marginals(emissions(codes, first, field.weights), first, field.pairs, field.start, with_pairs=False)
    return toxic, first


def _portions(column: pa.Array, size: int = 2_000_000) -> Iterator[list[bytes | None]]:
    """The texts of a column in portions of about `size` bytes."""
    portion, total = [], 0
    for data in byte_values(column):
        portion.append(data)
        total += len(data or b"")
        if total > size:
            yield portion
            portion, total = [], 0
    if portion:
        yield portion


def _lexicon(shared) -> tuple[Field, Lexicon]:
    """The field and the words a worker has met."""
    return kept(("lexicon", shared._path), lambda: (shared.value, Lexicon(shared.value.odds)))


def score(docs: DataFrame, field: Field, *, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """`key`, `score` (0 to 1), `n_toxic` (expected toxic tokens) and `spans` of every row of `docs`.

    A span is (start, stop) in bytes of the UTF-8 text: a maximal stretch of tokens whose marginal is at
    least one half. Null, empty and blank texts are one unknown token. Texts of any length are scored
    whole. Repeated rows and null keys stay as they are; other columns are ignored; an empty table gives
    an empty result. With `with_text` the texts come along.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # 12 bytes a cue; LABELLED bounds them
    kind = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("n_toxic", T.DoubleType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
            *([T.StructField("text", T.StringType())] if with_text else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lexicon = _lexicon(shared)
        for batch in batches:
            scores, expected, spans = [], [], []
            for portion in _portions(batch.column("text")):
                toxic, first = _tagged(own, lexicon, portion)
                x = (summaries(toxic, first) - own.centre) / own.scale
                scores.append(1 / (1 + np.exp(-np.clip(own.curve[0] + x @ own.curve[1:], -30, 30))))
                at = np.flatnonzero(first)
                expected.append(np.add.reduceat(toxic, at))
                hits = toxic >= 0.5
                for start, some, data in zip(at.tolist(), np.logical_or.reduceat(hits, at).tolist(), portion, strict=True):
                    spans.append(_spans(data, hits[start:]) if some else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                    pa.array(np.concatenate(expected) if expected else [], pa.float64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    *([batch.column("text")] if with_text else []),
                ],
                ["key", "score", "n_toxic", "spans", *(["text"] if with_text else [])],
            )

    return (
        docs.select(docs[key].alias("key"), docs[text].alias("text"))
        .mapInArrow(run, kind)
        .withColumnRenamed("key", key)
    )


_token = re.compile(rb"[^\x20\x09-\x0d]+")


def _spans(data: bytes | None, hits: np.ndarray) -> list[dict]:
    """The stretches of tokens that `hits`, which starts with those of this text, says are toxic."""
    places = [m.span() for m in _token.finditer(data or b"")] or [(0, len(data or b""))]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hits[: len(places)], [False]])))
    return [{"start": places[a][0], "stop": places[b - 1][1]} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`text`, `toxic` of the labelled documents outside the held-out third."""
    teaches = (F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & F.col("toxic").isNotNull()
    mine = stage(labels.where(teaches).select("doc_id", "toxic").distinct(), "teaching-labels")
    # Only texts with a label move, and by one plan at every size.
    named = within(docs.where("doc_id is not null").select("doc_id", "text"), F.xxhash64(F.col("doc_id").cast("long")), bitmap_of(mine.select(F.xxhash64(F.col("doc_id").cast("long")).alias("h")), "h"))
    return named.join(mine.hint("merge"), "doc_id").select("text", "toxic")


#: Score from which a document counts as toxic.
TOXIC = 0.7


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted`, `n_toxic`, `spans` of every document."""
    scored = score(docs, train(training_rows(docs, labels)))
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        "n_toxic",
        "spans",
    )
