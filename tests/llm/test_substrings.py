from __future__ import annotations

import hashlib
import random

import pytest

from civiclake.llm import queries, substrings
from civiclake.llm.chunks import words

SF = "/root/testdata/sf0.001"


def brute(rows, window):
    """Every window of every document against the windows of documents with smaller keys."""
    first: dict = {}
    texts = [(k, words(t.encode() if t is not None else None)) for k, t in rows]
    for key, own in texts:
        if key is not None:
            for i in range(len(own) - window + 1):
                w = tuple(own[i : i + window])
                first[w] = min(first.get(w, key), key)
    out = []
    for key, own in texts:
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            if key is not None and first[tuple(own[i : i + window])] < key:
                gone[i : i + window] = [True] * window
        kept = [w for w, g in zip(own, gone, strict=True) if not g]
        out.append((key, len(own), len(own) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def test_op3_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows_of(queries.op3_substring_dedup(spark, SF))
    assert got == brute(docs, 50) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("seed", range(3))
def test_small_alphabets_and_odd_rows(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p))
            parts += p[cut:] if rng.random() < 0.5 else p[: cut + 20]
            parts += [rng.choice("xyz")] * rng.randint(0, 3)
        rows.append((rng.choice([i, i, i // 2]), rng.choice([" ", "\n ", "\t"]).join(parts)))
    rows += [(None, rows[5][1]), (100, None), (101, ""), (102, "a " * 300), (103, "a " * 200), (0, rows[9][1]), rows[3], rows[3]]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, version int, place int")
    assert rows_of(substrings.dedup_digests(docs, window=12)) == brute(rows, 12)


def test_texts_and_spans(spark):
    long = " ".join(f"w{i}" for i in range(70))
    rows = [(1, f"x {long} y", "de"), (2, f"p  q\n{long} r", "fr"), (3, "kept  as it is", "en"), (None, long, "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted(substrings.dedup_texts(docs).collect(), key=lambda r: r.kept)
    assert got[0] == (1, f"x {long} y", "de") and got[1] == (3, "kept  as it is", "en")
    assert got[2] == (None, long, "es") and got[3] == (2, "p q r", "fr")
    assert [tuple(r) for r in substrings.spans(docs).collect()] == [(2, 2, 72)]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.dedup_digests(none).count() == 0 and substrings.dedup_texts(none).count() == 0
