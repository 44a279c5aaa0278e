from __future__ import annotations

import numpy as np

from civiclake.llm import prefix_forest, projection_forest, queries

SF = "/root/testdata/sf0.1"
NAN, INF = float("nan"), float("inf")
ODD = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [NAN, 1.0, 1.0, 1.0], [INF, 1.0, 1.0, 1.0], [1.0, 2.0]]


def embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").toPandas()
    return rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)


def brute_links(ids, vectors, least=0.95):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= least
    np.fill_diagonal(near, False)
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(near, label, ids.max()).min(axis=1))
        if (new == label).all():
            return near.sum(axis=1), label
        label = new


def test_op5_recall_and_distances(spark):
    ids, vectors = embeddings(spark)
    place = {v: i for i, v in enumerate(ids.tolist())}
    got: dict = {}
    for r in queries.op5_prefix_forest(spark, SF).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    assert set(got) == {v for v in place if v % 100 == 0}
    hits = 0
    for query, ranks in got.items():
        distance = np.sqrt(((vectors - vectors[place[query]]) ** 2).sum(axis=1))
        own = [ranks[i] for i in range(1, 11)]
        assert own == sorted(own) and all(abs(s - distance[place[v]]) < 1e-12 and v != query for s, v in own)
        best = sorted((d, v) for d, v in zip(distance.tolist(), ids.tolist(), strict=True) if v != query)[:10]
        hits += len({v for _, v in best} & {v for _, v in own})
    assert hits >= 0.95 * 10 * len(got)


def test_shards_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "SHARD", 30)
    monkeypatch.setattr(prefix_forest, "BLOCK", 3)
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=4).tolist()) for i in range(150)]
    good[7] = (7, good[0][1])  # a tie with id 0
    good[9] = (9, good[0][1])
    rows = [*good, *((1000 + i, v) for i, v in enumerate(ODD)), (None, good[3][1]), good[5], good[5]]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, vector int")
    got = prefix_forest.nearest(table, "vec_id % 10 = 0", k=5, wanted=50.0).collect()
    vectors = np.array([v for _, v in good])
    want = []
    for q in range(0, 150, 10):
        distance = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        want += [(q, rank, v, d) for rank, (d, v) in enumerate(sorted((d, v) for v, d in enumerate(distance.tolist()) if v != q)[:5], 1)]
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [w[:3] for w in want]
    few = prefix_forest.nearest(table.where("vec_id in (0, 7, 9)"), "vec_id = 0").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(few)] == [(1, 7, 0.0), (2, 9, 0.0)]
    for none in (table.limit(0), table.where("vec_id >= 1000 and vec_id < 1006"), table.where("vec_id = 0")):
        assert prefix_forest.nearest(none, "vec_id % 10 = 0").count() == 0


def test_few_rows_have_all_their_neighbours(spark):
    ids, vectors = embeddings(spark)
    for size in (2, 5, 20, 33, 50, 100):
        own = vectors[:size]
        table = spark.createDataFrame(list(enumerate(own.tolist())), "vec_id long, embedding array<double>").coalesce(1)
        got = sorted((r.query_id, r["rank"], r.vec_id) for r in prefix_forest.nearest(table, "true").collect())
        distance = np.sqrt(((own[:, None] - own) ** 2).sum(axis=2))
        want = []
        for q in range(size):
            order = sorted((d, v) for v, d in enumerate(distance[q].tolist()) if v != q)[:10]
            want += [(q, rank, v) for rank, (_, v) in enumerate(order, 1)]
        assert got == want


def test_op10_against_all_pairs(spark):
    ids, vectors = embeddings(spark)
    links, label = brute_links(ids, vectors)
    got = {r.vec_id: r for r in queries.op10_projection_forest(spark, SF).collect()}
    assert set(got) == set(ids.tolist())
    found = sum(r.n_links for r in got.values())
    assert 0.98 * links.sum() <= found <= links.sum()
    same = np.mean([got[v].component_id == c for v, c in zip(ids.tolist(), label.tolist(), strict=True)])
    assert same > 0.99 and all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_small_leaves_count_each_pair_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(12, 16))
    vectors = np.concatenate([base + 0.05 * rng.normal(size=base.shape) for _ in range(25)])
    classes = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, vector array<double>")
    homes = projection_forest.leaves(classes, leaf=40)
    assert homes.groupBy("home").count().agg({"count": "max"}).first()[0] <= 40
    vectors[40:60] = vectors[40]
    classes = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, vector array<double>")
    monkeypatch.setattr(projection_forest, "leaves", lambda v, f=projection_forest.leaves: f(v, leaf=150))
    got = {r.vec_id: r for r in projection_forest.near_duplicates(classes, vector="vector").collect()}
    links, label = brute_links(np.arange(len(vectors)), vectors)
    assert all(got[i].n_links <= links[i] for i in range(len(vectors)))
    assert sum(r.n_links for r in got.values()) >= 0.95 * links.sum()
    assert [got[i].component_id for i in range(len(vectors))] == label.tolist()


def test_groups_larger_than_a_leaf_have_all_their_links(spark, monkeypatch):
    monkeypatch.setattr(projection_forest, "leaves", lambda v, f=projection_forest.leaves: f(v, leaf=40))
    monkeypatch.setattr(projection_forest, "BLOCK", 100, raising=False)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(3, 64))
    vectors = np.concatenate([centres[0] + 0.1 * rng.normal(size=(600, 64)), centres[1] + 0.1 * rng.normal(size=(60, 64)), centres[2:], rng.normal(size=(40, 64))])
    vectors = np.concatenate([vectors, vectors[:300] * rng.uniform(0.1, 10, size=(300, 1)), vectors[660] * rng.uniform(0.1, 10, size=(200, 1))])
    links, label = brute_links(np.arange(len(vectors)), vectors)
    table = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in projection_forest.near_duplicates(table).collect())
    assert got == list(zip(range(len(vectors)), links.tolist(), label.tolist(), strict=True))


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (2, [2.0, 0.01, 0.0, 0.0]), (3, [0.0, 1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0, 0.0])]
    rows += [(1000 + i, v) for i, v in enumerate(ODD)] + [(None, [1.0, 0.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0, 0.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in projection_forest.near_duplicates(table).collect()), key=repr)
    want = [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (3, 0, 3, True), (5, 2, 1, False), (None, 0, None, False)]
    assert got == sorted(want + [(1000 + i, 0, 1000 + i, True) for i in range(len(ODD))], key=repr)
    assert projection_forest.near_duplicates(table.limit(0)).count() == 0
