from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from civiclake.llm import bpe, queries, token_counts
from civiclake.llm.chunks import RunValues

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "   x", "a  b", "a \n b", "a\n b", "a\n\n  b", "x\t y", "　a  b c", "a \x1cb\x1c c",
    "it's 'll we'd  's", "<|endoftext|> a <|endoftext|>b  <|endoftext|>", "a <|endoftext|>", "12 345  6,7", "é ü ß́ 日本語 🙂 🙂",
    "a" * 5000, ("ab " * 400) + " ", "trailing ", "\r\n x", "\u0085 y", "the the the",
]


@pytest.fixture(scope="module")
def hugging():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_docs(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(ODD)] + [(1, "the the the", 0, "x"), (None, "no key", 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, digest string")


def test_counts_of_odd_texts(spark, hugging, tmp_path):
    docs = odd_docs(spark)
    got = token_counts.count_tokens(docs, P.path("byte_bpe_50k.json"), str(tmp_path / "c")).collect()
    want = [
        (r.doc_id, len((r.text or "").encode()), len(hugging.encode(r.text or "", add_special_tokens=False).ids))
        for r in docs.collect()
    ]
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == sorted(want, key=key)
    assert {r.over_limit for r in got if r.n_tokens <= 1024} == {False}


def test_second_run_encodes_only_new_texts(spark, tmp_path, monkeypatch):
    path, cache = P.path("byte_bpe_50k.json"), str(tmp_path / "c")
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    first = token_counts.count_tokens(docs, path, cache).collect()
    folder = f"{cache}/tokenizer={token_counts.tokenizer_digest(path)}"
    assert spark.read.parquet(folder).count() == 2 and len(first) == 3
    more = docs.union(spark.createDataFrame([(4, "d e f")], docs.schema))
    again = token_counts.count_tokens(more, path, cache).collect()
    assert spark.read.parquet(folder).count() == 3
    assert {r.doc_id: r.n_tokens for r in again} == {1: 2, 2: 2, 3: 1, 4: 3}


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, P.path("byte_bpe_50k.json"), str(tmp_path / "c")).count() == 0
    assert bpe.round_trip(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_op1_against_the_library(spark, hugging):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op1_token_counts(spark, SF).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        n = len(hugging.encode(text, add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(text.encode()), n > 1024)


def test_perfect_hash_is_minimal_and_refuses_others():
    for keys in ([], [b"one"], [f"k{i}".encode() for i in range(5000)]):
        table = bpe.PerfectHash(keys)
        assert [table.find(k) for k in keys] == list(range(len(keys)))
        assert len(table.keys) == len(keys) and sorted(table.keys) == sorted(keys)
        assert table.find(b"other") == -1


def test_merges_equal_the_library(tik):
    own = bpe.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rng = random.Random(5)
    for text in [*filter(None, ODD), *("".join(rng.choice("abe \n'sé1.,日\t") for _ in range(60)) for _ in range(400))]:
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == tik.encode_ordinary(text), repr(text)
        assert own.decode(own.encode(text)) == text.encode()


def test_encode_then_decode(spark, tik):
    docs = odd_docs(spark)
    args = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    encoded = bpe.encode(docs, *args)
    back = sorted(bytes(r.decoded) for r in bpe.decode(encoded, *args).collect())
    assert back == sorted((r.text or "").encode() for r in docs.collect())


def test_op7_against_the_library(spark, tik):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op7_byte_bpe(spark, SF).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        ids = np.array(tik.encode_ordinary(text), "<u4")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_a_pre_token_is_merged_once_in_runs_that_differ(tik, monkeypatch):
    """What follows a word makes another run of it, but the word's ids are known; the worker keeps so many and no more."""
    own = bpe.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    merged = []
    merge = own.merge
    monkeypatch.setattr(own, "merge", lambda data: merged.append(data) or merge(data))
    text = "x xqzvkw xqzvkw, xqzvkw. xqzvkw; xqzvkw.\nxqzvkw"
    for _ in range(2):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tik.encode_ordinary(text)
    assert merged.count(b" xqzvkw") == 1 and merged.count(b"xqzvkw") == 1
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    for i in range(50):
        assert own.decode(own.encode(f"a b{i}zq c{i}zq")) == f"a b{i}zq c{i}zq".encode()
    assert len(own.pieces) <= 3


def test_kept_runs_are_bounded():
    kept = RunValues(len, limit=3)
    assert kept.of("a b c d e f g") == [1, 2, 2, 2, 2, 2, 2] and len(kept) <= 3
