from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from civiclake.llm import ngram_join, queries
from civiclake.llm.components import components

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    own = (text or "").encode().lower().split()
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def brute(rows):
    """All pairs of rows, and the smallest key each row reaches."""
    sets = [(k, shingle_set(t)) for k, t in rows]
    group = [{i} for i in range(len(sets))]
    for i, j in combinations(range(len(sets)), 2):
        (a, x), (b, y) = sets[i], sets[j]
        if None not in (a, b) and x and y and 100 * len(x & y) >= 75 * len(x | y) and group[i] is not group[j]:
            group[i] |= group[j]
            for k in group[j]:
                group[k] = group[i]
    return sorted(
        ((k, len(s), None if k is None else min(sets[i][0] for i in g)) for (k, s), g in zip(sets, group, strict=True)), key=repr
    )


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_op8_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows_of(queries.op8_ngram_join(spark, SF))
    assert got == brute(docs) and any(r[0] != r[2] for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_ties_and_odd_rows(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(8):  # chains whose ends are not similar, and sets around the threshold
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([6, 9, 30, 60]))]
        for _ in range(rng.randint(2, 9)):
            rows.append((rng.randint(0, 10**6), " ".join(words)))
            at = rng.randrange(len(words))
            words = words[:at] + [f"v{rng.randint(0, 10**6)}"] * rng.randint(0, 1) + words[at + rng.randint(0, 2) :]
    rows += [(10**7, None), (10**7 + 1, ""), (10**7 + 2, " \n"), (5, "One two"), (4, "one TWO"), (3, "two one"), (None, "one two")]
    rows += [(10**7 + 9, rows[0][1]), rows[1], (rows[2][0], "another text with the same key here")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, name int")
    assert rows_of(ngram_join.near_duplicates(docs)) == brute(rows)


def test_empty_table(spark):
    assert ngram_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_finds_what_pairs_find():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(1, 1 << 60, 80).astype(np.uint64))
    sets = []
    for _ in range(60):
        own = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.3])]
        sets.append(np.unique(np.append(own, rng.integers(1, 1 << 60, rng.integers(0, 12)).astype(np.uint64))))
    counts = np.zeros(ngram_join.BUCKETS, np.uint32)
    in_order = [ngram_join.ordered(s, counts) for s in sets]
    found = dict(ngram_join.Tree(in_order, in_order).similar(base))
    for i, own in enumerate(sets):
        both = len(np.intersect1d(own, base))
        assert (100 * both >= 75 * (len(own) + len(base) - both)) == (i in found)
        assert found.get(i, both) == both


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(30)] + [(7, 7), (200, 201)]
    label: dict = {}
    for a, b in edges:
        if a != b:
            x, y = label.setdefault(a, {a}), label.setdefault(b, {b})
            x |= y
            for k in y:
                label[k] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: min(v) for k, v in label.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_passage_in_many_dissimilar_texts(spark, monkeypatch):
    """2,000 texts around one passage: few candidates, though all share its shingles."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for i in range(2000):
        own = [f"u{rng.randint(0, 10**9)}" for _ in range(rng.randint(18, 60))]
        rows.append((i, " ".join(own[:9] + passage + own[9:])))
    rows += [(5000 + i, rows[i][1] + " more") for i in range(20)]
    counted = []

    def counting(df, label):
        done = stage(df, label)
        if label == "candidate-pairs":
            counted.append(done.count())
        return done

    stage = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", counting)
    got = rows_of(ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {k: c for k, _, c in got} == {k: k % 5000 for k, _ in rows}
    assert sum(counted) < 3 * len(rows)


def test_parts_of_an_element_meet_in_cells(spark, monkeypatch):
    """With small parts and no pivots, the cells alone find all links, each within or across parts."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(base[rng.randint(0, 3) : 40 - rng.randint(0, 3)] + [f"x{i}"])) for i in range(60)]
    monkeypatch.setattr(ngram_join, "PART", 4)
    monkeypatch.setattr(ngram_join, "PIVOTS", ())
    assert rows_of(ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_few_shared_elements_make_no_candidate_of_a_pivot(spark):
    """Sets of 100 elements, similar ones of which share 12 of their first 26: 3 are too few, though they come first."""
    entries = []
    for pair, shared in enumerate((3, 12)):
        for name in (2 * pair + 1, 2 * pair + 2):
            entries += [(100 * pair + i, name, i * ngram_join._HALF + 100, name) for i in range(shared)]
    rows = spark.createDataFrame(entries, "element long, name long, place long, component long")
    assert sorted(tuple(r) for r in ngram_join._across(rows).collect()) == [(1, 2), (3, 4)]  # the last round leaves none out
    for orders in ((None,), (1,)):
        assert [sorted(r) for r in ngram_join._with_pivots(rows, orders, 0.0).collect()] == [[3, 4]]


def test_sets_that_share_rare_elements_but_are_apart_are_no_candidates(spark, monkeypatch):
    """Each of 40 texts shares half of its elements with the text before; no text of such a pair has to be fetched."""
    passages = [[f"p{i}x{j}" for j in range(40)] for i in range(40)]
    rows = [(i, " ".join(passages[i] + passages[i - 1])) for i in range(40)]
    rows += [(100 + i, rows[i][1] + " more") for i in range(3)]
    counted = []

    def counting(df, label):
        done = stage(df, label)
        if label == "candidate-pairs":
            counted.append(done.count())
        return done

    stage = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", counting)
    assert rows_of(ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert sum(counted) <= 2 * 3


@pytest.mark.parametrize("size", [5, 130, 300, 3000])
def test_sketches_never_rule_out_similar_sets(spark, size):
    """From far below to far above the threshold, by the definition."""
    rng = np.random.default_rng(size)
    base = np.unique(rng.integers(1, 1 << 62, size).astype(np.uint64))
    sets = [base] + [np.unique(np.append(base[i:], rng.integers(1, 1 << 62, i).astype(np.uint64))) for i in range(0, size, max(1, size // 30))]
    sets += [base[i:] for i in range(0, size // 2, max(1, size // 30))]  # some have half as many places
    texts = spark.createDataFrame([(i, len(s), ngram_join.sketch(s).tolist()) for i, s in enumerate(sets)], "name long, n_shingles long, sketch array<long>")
    pairs = spark.createDataFrame([(0, i) for i in range(1, len(sets))], "pivot long, name long")
    kept = {r.name for r in ngram_join._not_apart(pairs, texts).collect()}
    similar = {i for i, s in enumerate(sets) if i and 100 * len(np.intersect1d(base, s)) >= 75 * len(np.union1d(base, s))}
    assert similar <= kept and len(kept) < len(similar) + 8


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_rows_go_on_with_a_set_they_may_link_with(size):
    """Whatever the batches: not size alone, but what is left from the shared element on."""
    rng = np.random.default_rng(size)
    rows = []
    for element in range(300):
        for _ in range(rng.integers(1, 6)):
            n = int(rng.integers(1, 40))
            rows.append((element, int(rng.integers(1 << 40)), int(rng.integers(n + (-3 * n // 4) + 1)), n))
    rows.sort(key=lambda r: (r[0], r[3], r[1]))
    wanted = [
        a for a in rows
        if any(b is not a and b[0] == a[0] and 4 * min(a[3] - a[2], b[3] - b[2]) >= 3 * max(a[3], b[3]) for b in rows[max(0, rows.index(a) - 6) : rows.index(a) + 7])
    ]
    twice = [r for r in rows for _ in range(1 + r[1] % 2)]  # copies of a set from different tasks
    table = pa.table({"element": [r[0] for r in twice], "name": [r[1] for r in twice], "place": [(r[2] << 31) + r[3] for r in twice]})
    got = [tuple(r.values()) for batch in ngram_join._sharing(iter(table.to_batches(max_chunksize=size))) for r in batch.to_pylist()]
    assert got == [(e, name, (place << 31) + n) for e, name, place, n in wanted]


def test_rows_of_an_element_move_once_a_round(spark):
    rows = spark.createDataFrame([], "element long, name long, place long, component long")
    pivots = ngram_join._with_pivots(rows, (None, 1), 0.5)._jdf.queryExecution().optimizedPlan().toString()
    across = ngram_join._across(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in pivots + across and pivots.count("Window [") == across.count("Window [") == 1
