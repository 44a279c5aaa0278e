from __future__ import annotations

import hashlib
from collections import defaultdict
from math import floor

import numpy as np
import pytest

from civiclake.llm import limb_codes, queries
from tests.compare import connect, differences

NAN, INF = float("nan"), float("inf")


def brute(rows, parts, entries, rounds):
    """Python integers all the way; rows are (vec_id, vector, label)."""
    kept = [(i, [floor(256 * x) for x in v], y) for i, v, y in rows]
    cut = lambda v: [v[k * len(v) // parts : (k + 1) * len(v) // parts] for k in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1], r[2] is not None, r[2] or 0))[:entries]
    books = [list(b) for b in zip(*(cut(v) for _, v, _ in first), strict=True)]

    def assign(v):
        out = []
        for part, book in zip(cut(v), books, strict=True):
            out.append(min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book)))
        return out

    for _ in range(rounds):
        members = [defaultdict(list) for _ in range(parts)]
        for _, v, _ in kept:
            for p, (part, (_, code)) in enumerate(zip(cut(v), assign(v), strict=True)):
                members[p][code].append(part)
        for p in range(parts):
            for code, own in members[p].items():
                books[p][code] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    by_label = defaultdict(int)
    done = []
    for i, v, y in kept:
        found = assign(v)
        error = sum(d for d, _ in found)
        by_label[y] += error
        done.append((i, "".join(f"{code:02x}" for _, code in found), error, y))
    name = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[y], name) for i, code, error, y in done), key=repr)


def compressed(table, **shape):
    return sorted((tuple(r) for r in limb_codes.compress(table, **shape).collect()), key=repr)


def test_products_are_exact_where_float64_is_not():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-(2**28), 2**28, size=(n, 13)) for n in (50, 40))
    a[0], b[0] = 2**28, -(2**28)
    exact = np.array([[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a])
    assert (limb_codes.exact_products(a, b) == exact).all()
    one = np.array([[2**30 + 1]]), np.array([[2**31 - 1]])
    assert limb_codes.exact_products(*one)[0, 0] == (2**30 + 1) * (2**31 - 1) != int(float(2**30 + 1) * float(2**31 - 1))
    for bits in (5, 23):
        parts = limb_codes.limbs(a, bits)
        assert all(np.abs(p).max() < 2**bits for p in parts)
        assert (sum(p.astype(np.int64) << (bits * i) for i, p in enumerate(parts)) == a).all()


@pytest.mark.parametrize("size, scale", [(8, 1.0), (8, 3.0e5), (32, 0.02)])
def test_against_python_integers(spark, monkeypatch, size, scale):
    monkeypatch.setattr(limb_codes, "BLOCK", 7)
    rng = np.random.default_rng(size)
    vectors = scale * rng.normal(size=(90, size))
    vectors[20:50] = vectors[3]  # a large group of copies
    labels = [None if i % 11 == 0 else i % 4 for i in range(90)]
    rows = [(i, v, y) for i, (v, y) in enumerate(zip(vectors.tolist(), labels, strict=True))]
    rows += [(5, rows[5][1], 1), (5, rows[6][1], 1), (None, rows[7][1], 2), (-4, [-0.001] * size, None)]
    bad = [(100, None, 1), (101, [], 1), (102, [NAN] * size, 1), (103, [1.0] * (size - 1) + [INF], 1), (104, [None] + [1.0] * (size - 1), 1), (105, [1.0, 2.0], 1), (106, [1e300] * size, 1)]
    table = spark.createDataFrame([(*r, 0, 0) for r in rows + bad], "vec_id long, embedding array<double>, label int, code int, error int").repartition(6)
    shape = {"parts": 4, "entries": 9, "rounds": 2}
    assert compressed(table, **shape) == brute(rows, **shape)


def test_hot_and_other_labels_have_the_same_sums(spark, monkeypatch):
    rows = [(i, [i / 7, -i / 3, float(i % 5), 1.0], None if i % 3 == 0 else f"label {i % 50}") for i in range(200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    shape = {"parts": 2, "entries": 5, "rounds": 1}
    exact = [(i, np.array(v, dtype=np.float32).astype(float).tolist(), y) for i, v, y in rows]
    want = brute(exact, **shape)
    for share in (1, 10, 1024):
        monkeypatch.setattr(limb_codes, "HOT_SHARE", share)
        assert compressed(table, **shape) == want


def test_few_rows_and_none(spark):
    one = spark.createDataFrame([(3, [1.0, 2.0, 3.0], None)], "vec_id long, embedding array<double>, label int")
    got = limb_codes.compress(one).first()  # three components in 16 parts: filled with zeros
    assert (got.vec_id, got.code, got.error, got.label_error) == (3, "00" * 16, 0, 0)
    for none in (one.limit(0), one.where("false"), spark.createDataFrame([(1, [NAN], 1)], one.schema)):
        assert limb_codes.compress(none).count() == 0


def test_op11_against_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        assert differences(queries.op11_limb_codes(spark, sf), connect(sf), queries.ORACLE["op11_limb_codes"]) == []
