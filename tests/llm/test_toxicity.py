from __future__ import annotations

import gc
import types
import weakref
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civiclake.llm import chunks, packing, queries, toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("sizes", [[1], [3], [4, 1, 5], [2] * 7])
def test_marginals_against_all_taggings(sizes):
    rng = np.random.default_rng(len(sizes))
    pairs, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    emission = rng.normal(size=sum(sizes)) * 3
    first = np.zeros(sum(sizes), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    toxic, both, log_z = toxicity.marginals(emission, first, pairs, start)
    at, total = 0, 0.0
    for size in sizes:
        e, sums, pair_sums, z = emission[at : at + size], np.zeros(size), np.zeros((size, 2, 2)), 0.0
        for tags in product((0, 1), repeat=size):
            p = np.exp(start[tags[0]] + sum(e[i] * t for i, t in enumerate(tags)) + sum(pairs[a, b] for a, b in zip(tags, tags[1:], strict=False)))
            z += p
            sums += p * np.array(tags)
            for i, (a, b) in enumerate(zip(tags, tags[1:], strict=False), 1):
                pair_sums[i, a, b] += p
        assert np.allclose(toxic[at : at + size], sums / z)
        assert np.allclose(both[at + 1 : at + size].reshape(-1, 2, 2), pair_sums[1:] / z)
        total += np.log(z)
        at += size
    assert np.isclose(log_z, total)


def test_emissions_are_the_features_weights():
    rng = np.random.default_rng(2)
    weights, codes = rng.normal(size=toxicity.FEATURES), rng.integers(0, toxicity.UNKNOWN, 60, endpoint=True).astype(np.uint8)
    first = rng.random(60) < 0.2
    first[0] = True
    classes = np.stack(np.divmod(codes.astype(np.int64), toxicity.CLASSES))
    assert np.allclose(toxicity.emissions(codes, first, weights), weights[toxicity.features(classes, first)].sum(axis=0))


def test_long_chains_stay_finite():
    rng = np.random.default_rng(0)
    toxic, _, log_z = toxicity.marginals(rng.normal(size=50_000) * 30, np.arange(50_000) == 0, np.array([[3.0, -9], [-9, 3]]), np.zeros(2))
    assert np.isfinite(toxic).all() and np.isfinite(log_z) and toxic.min() >= 0 and toxic.max() <= 1


def test_op2_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op2_toxicity(spark, SF).select("doc_id", "held_out", "score", "predicted")
    assert got.count() == docs.count()
    labelled = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in labelled if r.toxic == y] for y in (0, 1))
    order = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert order > 0.9
    assert np.mean([r.predicted == r.toxic for r in labelled]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in labelled)


def test_odd_rows_and_spans(spark):
    clean = [(i, f"the quiet garden number n{i} was green", 0) for i in range(60)]
    toxic = [(100 + i, f"the vile{i % 7}x person n{i} was vile", 1) for i in range(40)]
    rows = [*clean, *toxic, (200, None, 1), (201, "no label", None)]
    field = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    docs = spark.createDataFrame(
        [(1, "A VILE thing\nof vile9x", "a"), (2, None, "b"), (3, "", "c"), (3, "", "c"), (None, "the quiet garden", "d"), (4, "green " * 30_000, "e")],
        "doc_id long, text string, score string",
    )
    got = sorted(toxicity.score(docs, field).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [1, 2, 3, 3, 4, None]
    assert got[0].score > 0.7 > max(r.score for r in got[1:])
    assert [tuple(s) for s in got[0].spans][0] == (2, 6)
    spaced = b"  a\n\nVILE   thing \xc3\xa4 vile1x."
    spans = toxicity.score(spark.createDataFrame([(1, spaced.decode())], "doc_id long, text string"), field).first().spans
    assert {spaced[s.start : s.stop].split()[0] for s in spans} <= {b"VILE", b"vile1x."} and spans[0].start == 5
    assert all(not r.spans for r in got[1:]) and [tuple(s) for s in got[0].spans][0] == (2, 6) and all(not r.spans for r in got[1:])
    assert toxicity.score(docs.limit(0), field).count() == 0


def test_cues_are_counted_by_documents(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD_CUES", 50)
    rows = [(f"alpha beta{i % 3} alpha gamma{i}", i % 2, i % 3) for i in range(60)]
    table = spark.createDataFrame(rows, "text string, toxic long, fold long").coalesce(3)
    counted = table.mapInArrow(toxicity._cue_counts, ", ".join(f"{c} long" for c in ("cue", *toxicity._COUNTERS)))
    got = {r[0]: list(r[1:]) for r in counted.groupBy("cue").sum().drop("sum(cue)").collect()}
    want = {}
    for text, toxic, fold in rows:
        for cue in {h for w in text.encode().split() for h in toxicity.cue_hashes(w)}:
            want.setdefault(cue, [0] * 6)[2 * fold + toxic] += 1
    assert got == want


def test_a_share_of_many_labelled_documents_teaches(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LABELLED", 120)
    rows = [(f"the quiet garden number n{i} was green", 0) for i in range(300)] + [(f"the vile{i % 7}x person n{i} was vile", 1) for i in range(200)]
    field = toxicity.train(spark.createDataFrame(rows, "text string, toxic int"))
    assert 0 < len(field.odds.cues) < 200
    docs = spark.createDataFrame([(1, "a vile person"), (2, "the quiet garden")], "doc_id long, text string")
    assert {r.doc_id: r.score > 0.7 for r in toxicity.score(docs, field).collect()} == {1: True, 2: False}


def test_one_label_only(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for value in (0, 1):
        field = toxicity.train(docs.withColumn("toxic", F.lit(value)))
        assert [round(r.score) for r in toxicity.score(docs, field).collect()] == [value] * 2
    field = toxicity.train(docs.withColumn("toxic", F.lit(None).cast("int")))
    assert [round(r.score) for r in toxicity.score(docs, field).collect()] == [0, 0]


def test_long_texts_teach_by_all_their_words(spark):
    """The toxic words of the toxic documents stand behind a thousand clean ones."""
    clean = [(i, f"n{i} " + "the quiet garden was green " * 220, 0) for i in range(60)]
    toxic = [(100 + i, f"n{i} " + "the quiet garden was green " * 200 + "a vile person is vile", 1) for i in range(40)]
    field = toxicity.train(spark.createDataFrame(clean + toxic, "doc_id long, text string, toxic int"))
    new = [(1, "the quiet garden was green " * 210 + "a vile person is vile"), (2, "the quiet garden was green " * 210)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(new, "doc_id long, text string"), field).collect()}
    assert got[1] > 0.7 > got[2]


def test_fitting_takes_different_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_DOCS", {0: 3, 1: 2})
    rows = [("same " * 2000, 0)] * 30 + [(f"word{i} " * 1500, 0) for i in range(5)] + [("vile " * 900, 1)] * 4
    got = toxicity.fitting_rows(spark.createDataFrame(rows, "text string, toxic long")).collect()
    assert sorted(r.toxic for r in got) == [0, 0, 0, 1] and len({r.text for r in got}) == 4
    assert {r.text for r in got} <= {text for text, _ in rows}


def test_a_worker_keeps_one_operators_things():
    """What another operator has kept is gone before a task gathers cues, fills a lexicon or loads a vocabulary."""

    class Thing:
        pass

    def holds():
        gc.collect()
        return alive() is not None

    for starts in (lambda: list(toxicity._cue_counts(iter([]))), lambda: chunks.kept("other", lambda: [holds()])):
        alive = weakref.ref(chunks.kept("first", Thing))
        assert chunks.kept("first", Thing) is alive() and holds()
        assert starts() in ([], [False]) and not holds()
    shared = types.SimpleNamespace(_path="a", value=types.SimpleNamespace(odds=toxicity.Odds(np.empty(0, np.int64), np.empty((0, 4), np.uint8))))
    lexicon = weakref.ref(toxicity._lexicon(shared)[1])
    path, ranks = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    ids = weakref.ref(packing._ids(path, ranks, public_tokenizers.PATTERN))
    gc.collect()
    assert lexicon() is None and packing._ids(path, ranks, public_tokenizers.PATTERN) is ids()
    toxicity._lexicon(shared)
    gc.collect()
    assert ids() is None


def test_counts_of_cues_by_part_and_label():
    rng = np.random.default_rng(8)
    rows = [(" ".join(f"word{rng.integers(40)}" for _ in range(9)), int(rng.integers(2)), int(rng.integers(3))) for _ in range(50)] + [(None, 1, 0), ("", 0, 2)]
    batch = pa.RecordBatch.from_pylist([{"text": t, "toxic": y, "fold": f} for t, y, f in rows])
    (got,) = toxicity._cue_counts(iter([batch]))
    plain = Counter((cue, f"n{f}{y}") for t, y, f in rows for cue in {c for w in (t or "").encode().split() for c in toxicity.cue_hashes(w)})
    assert {(r["cue"], c): n for r in got.to_pylist() for c, n in r.items() if c != "cue" and n} == plain
