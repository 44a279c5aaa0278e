from __future__ import annotations

from math import floor

import numpy as np
import pytest

from civiclake.llm import queries, residue_negatives
from tests.compare import connect, differences

NAN, INF = float("nan"), float("inf")


def brute(rows, n_positives=5, n_negatives=5, least=80):
    """Python integers; rows are (vec_id, vector, label), every tenth an anchor."""
    whole = {i: ([floor(256 * x) for x in v], y) for i, v, y in rows}
    found = []
    for a, (v, y) in whole.items():
        if a % 10:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), i, z) for i, (w, z) in whole.items() if i != a)
        for s, i, _ in [x for x in scored if x[2] == y][:n_positives]:
            near = [x for x in scored if x[2] != y and least * -s <= 100 * -x[0] <= 100 * -s][:n_negatives]
            found += [(a, i, rank, j, -s, -t) for rank, (t, j, _) in enumerate(near, 1)]
    return sorted(found)


def mined(table, **limits):
    return sorted(tuple(r) for r in residue_negatives.mine(table, "vec_id % 10 = 0", **limits).collect())


@pytest.mark.parametrize("size, largest", [(3, 4), (64, 2000), (64, 2**22), (700, 9), (5000, 3)])
def test_scores_are_exact(size, largest):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-largest, largest, size=(20, size), endpoint=True) for _ in range(2))
    a[0], b[0], b[1] = largest, largest, -largest
    moduli = residue_negatives.primes(size, size * largest**2)
    small = [residue_negatives.residues(x, moduli) for x in (a, b)]
    assert all(size * float(np.abs(r).max()) ** 2 < 2**24 for part in small for r in part)
    assert (residue_negatives.scores(*small, moduli) == a @ b.T).all()
    assert len(set(moduli)) == len(moduli) and all(p % d for p in moduli for d in range(2, p))


ROWS_SEED = 6


def some_rows(n=230, size=6, labels=4):
    rng = np.random.default_rng(ROWS_SEED)
    vectors = rng.normal(size=(n, size)).round(1) + 0.4  # rounded: ties
    vectors[30:90] = vectors[10]  # a large group of copies under several labels
    vectors[120:121] = 0.0
    return [(i, v, int(y)) for i, (v, y) in enumerate(zip(vectors.tolist(), rng.integers(0, labels, n), strict=True))]


@pytest.mark.parametrize("shard, block, tile", [(2**20, 2**21, (256, 4096)), (200, 40, (3, 17)), (60, 600, (1, 1))])
def test_blocks_shards_and_tiles(spark, monkeypatch, shard, block, tile):
    for name, value in (("SHARD_CELLS", shard), ("BLOCK_CELLS", block), ("TILE", tile)):
        monkeypatch.setattr(residue_negatives, name, value)
    rows = some_rows()
    odd = [(300, None, 1), (310, [NAN] * 6, 1), (320, [INF] * 6, 1), (330, [None] * 6, 1), (340, [1.0] * 6, None), (None, [1.0] * 6, 1), (350, [1.0], 1), (360, [1e200] * 6, 1), (370, [], 2)]
    table = spark.createDataFrame([(*r, 1, 1) for r in rows + odd + rows[10:12]], "vec_id long, embedding array<double>, label int, rank int, shard int").repartition(3)
    got = mined(table)
    assert got == brute(rows) and len(got) > 100
    assert mined(table, n_positives=2, n_negatives=3, least_percent=95) == brute(rows, 2, 3, 95)


def test_large_components_and_negative_scores(spark):
    rows = [(i, [x * 1e5 for x in v], y) for i, v, y in some_rows(80)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(table) == brute(rows)
    apart = [(0, [1.0, -0.5], 1), (1, [-2.0, 0.0], 1), (2, [-2.0, 0.1], 2), (3, [-1.7, 0.0], 2), (4, [0.0, 0.0], 2), (5, [0.0, 0.0], 1)]
    table = spark.createDataFrame(apart, "vec_id long, embedding array<double>, label int")
    assert mined(table) == brute(apart) == [(0, 5, 1, 4, 0, 0)]  # nothing lies between a negative score and four fifths of it


def test_repeated_ids_take_part_once(spark):
    rows = some_rows(40)
    table = spark.createDataFrame(rows + [(7, [9.0] * 6, 0), (7, rows[7][1], rows[7][2])], "vec_id long, embedding array<double>, label int")
    one = [r for r in rows if r[0] != 7] + [(7, *min((rows[7][1:], ([9.0] * 6, 0))))]
    assert mined(table) == brute(one)


def test_tables_without_pairs(spark):
    rows = some_rows(20)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for none in (table.limit(0), table.where("vec_id = 0"), table.where("vec_id % 10 > 0"), table.where("label = 1"), table.selectExpr("vec_id", "embedding", "cast(null as int) label")):
        assert mined(none) == []
    zero = table.selectExpr("vec_id", "array(0.0d) embedding", "vec_id % 2 label")
    assert mined(zero) == brute([(i, [0.0], i % 2) for i in range(20)])


def test_op12_against_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        assert differences(queries.op12_residue_negatives(spark, sf), connect(sf), queries.ORACLE["op12_residue_negatives"]) == []
