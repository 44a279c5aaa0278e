from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from civiclake.llm import packing, queries
from tests.llm.test_tokens import odd_docs

SF = "/root/testdata/sf0.001"


def check(rows, texts, size=2048):
    """Pieces against the library, and sequences without gaps or overlaps."""
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for key, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        low, high, piece = 0, len(ids) % size or size, 0
        while low < len(ids):
            want.append((key, piece, low, high - low, zlib.crc32(ids[low:high].tobytes())))
            low, high, piece = high, high + size, piece + 1
    order = lambda r: tuple(-1 if v is None else v for v in r)
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=order) == sorted(want, key=order)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), -(-sum(r.length for r in rows) // size)


def test_op9(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    used, least = check(queries.op9_packing(spark, SF).collect(), docs)
    assert used <= least + 1


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = packing.pack(docs, P.path("byte_bpe_50k.json"), size=64).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 64)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none, P.path("byte_bpe_50k.json")).count() == 0


def test_rank_file_gives_the_same_ids():
    args = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    fast, plain = packing.Ids(*args), packing.Ids(args[0], None, None)
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "be", " ", "\n", "<|endoftext|>", "é", "日", "'s", "1", "."]) for _ in range(40))
        assert fast.of(text) == plain.of(text)


def test_local_search_empties_bins():
    lengths = [7, 7, 5, 5, 3, 3]
    bins = [[0, 2], [1, 3], [4, 5]]  # 12, 12 and 6 of 15
    done = packing.improve([list(b) for b in bins], lengths, 15)
    assert len(done) == 2 and sorted(i for b in done for i in b) == list(range(6))
    rng = random.Random(9)
    for _ in range(50):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(0, 200))]
        first = packing.best_fit(lengths, 100)
        done = packing.improve([list(b) for b in first], lengths, 100)
        assert sorted(i for b in done for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in done) and len(done) <= len(first)


def test_exchange_prefers_what_fills_best():
    lengths = [10, 6, 3, 8, 5]
    assert packing._exchange([(0,), (1,)], [(0, 1)], lengths, 7, []) == ((1,), ())
    assert packing._exchange([(0,)], [], lengths, 2, [3]) == ((0,), (3,))  # one for one
    assert packing._exchange([(1,), (2,)], [(1, 2)], lengths, 1, [3]) == ((1, 2), (3,))  # two for one
    assert packing._exchange([(0,)], [], lengths, 2, [2, 4]) == ((0,), (2, 4))  # one for two
