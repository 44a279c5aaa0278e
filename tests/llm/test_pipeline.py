from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from civiclake.llm import queries, toxicity
from tests.llm import test_ngram_join, test_packing, test_substrings

SF = "/root/testdata/sf0.001"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def cut_by_brute_force(rows):
    """Texts of the third stage, by the windows of the rows with smaller ids."""
    kept = {r[0]: r for r in test_substrings.brute(rows, 50)}
    out = {}
    for key, text in rows:
        _, n_words, n_removed, digest = kept[key]
        out[key] = (n_words - n_removed, digest if n_removed else None, text)
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results = []
    for i, (_, function) in enumerate(pipeline.STAGES):
        function(spark, docs, SF).write.parquet(path := f"{tmp_path}/{i}")
        if i < 3:
            assert spark.read.parquet(path).dtypes == docs.dtypes
        docs = spark.read.parquet(path)
        results.append(docs)
    everything = pairs(spark.read.parquet(f"{SF}/documents.parquet"))
    scored = toxicity.predict(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in scored.where("predicted = 0").collect()}
    first = [(k, t) for k, t in everything if k in clean]
    assert sorted(pairs(results[0])) == sorted(first)
    second = {k for k, _, c in test_ngram_join.brute(first) if k == c}
    assert sorted(pairs(results[1])) == sorted((k, t) for k, t in first if k in second)
    third = cut_by_brute_force(pairs(results[1]))
    got = {r.doc_id: r for r in results[2].collect()}
    assert set(got) == {k for k, (left, digest, _) in third.items() if left or digest is None}
    for k, row in got.items():
        left, digest, text = third[k]
        assert len(row.text.encode().split()) == left and row.n_chars == len(row.text)
        assert digest is not None or row.text == text
    used, least = test_packing.check(results[3].collect(), pairs(results[2]))
    assert used <= least + 1
    whole = pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.drop("sequence_id", "offset").collect())) == sorted(map(tuple, results[3].drop("sequence_id", "offset").collect()))


@pytest.mark.parametrize("stage", [0, 1, 2])
def test_odd_rows(spark, stage, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, None, None, None, None), (None, "a b c", "en", "s", 5), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("version", F.lit(1))
    got = pipeline.STAGES[stage][1](spark, docs, str(tmp_path))
    assert got.dtypes == docs.dtypes
    want = sorted((r[:2] for r in rows), key=repr)
    if stage == 1:
        want.remove((1, "a b c"))
    assert sorted(pairs(got), key=repr) == want
    assert pipeline.STAGES[stage][1](spark, docs.limit(0), str(tmp_path)).count() == 0


@pytest.mark.parametrize("stage", [0, 1, 2])
def test_odd_column_names(spark, stage, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5, "x", "y")], "doc_id long, text string, lang string, source string, n_chars long, `my col` string, `a.b` string")
    got = pipeline.STAGES[stage][1](spark, docs, str(tmp_path))
    assert got.dtypes == docs.dtypes and [tuple(r) for r in got.collect()] == [(1, "a b c", "en", "s", 5, "x", "y")]


def test_nulls_are_not_judged(spark, tmp_path):
    """Where the field calls everything toxic, rows without an id or a text stay."""
    spark.createDataFrame([(i, 1, 1) for i in range(20)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, "vile words", "en", "s", 10) for i in range(20)] + [(None, "vile words", "en", "s", 10), (30, None, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(pairs(pipeline.drop_toxic(spark, docs, str(tmp_path))), key=repr) == [(30, None), (None, "vile words")]


def test_registered(spark):
    assert queries.QUERIES["pipeline"] is pipeline.run
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near duplicates", "substring dedup", "packing"]


@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_texts_go_to_python_in_batches_of_bounded_size(spark, stage, tmp_path):
    """However long texts are, a stage sets the bound before Python gets them."""
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    pipeline.STAGES[stage][1](spark, docs, str(tmp_path))

    def sizes(batches):
        for batch in batches:
            yield batch.select(["text"]).slice(0, 1).set_column(0, "text", [str(batch.num_rows)])

    long = spark.range(64).selectExpr("repeat('x', 1000000) as text").coalesce(1)
    assert max(int(r.text) for r in long.mapInArrow(sizes, "text string").collect()) <= 10
