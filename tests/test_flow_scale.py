"""What the flow does for each row of a large register: wide work once, and nothing in too few tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.functions.numbers import canonical_number
from civiclake.operators import revisions as R
from civiclake.operators.digests import bitmap_of, within
from civiclake.plans import flow_queries
from civiclake.register import flow
from civiclake.register.schema import COLUMNS
from civiclake.session import tune
from civiclake.sources import landing as L
from tests.rows import row, write_csv


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_text_with_a_digit_is_cast(spark):
    given = {
        "2560.0": "2560", "2560.00": "2560", "02560": "2560", "100": "100", "0.000": "0", "-0.5": "-0.5", "1e2": "100", "0.0000001": "0",
        " 7 ": "7", "٣.0": "3", "NA": "NA", "": "", ".": ".", "0x": "0x", "9" * 40: "9" * 40, None: None,
    }
    df = spark.createDataFrame([(k,) for k in given], "t string").select("t", canonical_number(F.col("t")).alias("c"))
    assert {r.t: r.c for r in df.collect()} == given
    assert _plan(df.where("c IS NOT NULL")).index("RLIKE") < _plan(df.where("c IS NOT NULL")).index("cast(")


def test_the_bitmap_filter_computes_a_hash_once(spark, tmp_path):
    spark.range(1000).select("id", F.col("id").cast("string").alias("x")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).select("x", F.xxhash64(*["x"] * 90).alias("h"))
    some = rows.where("x IN ('3', '77')").select("h").localCheckpoint()
    kept = within(rows, F.col("h"), bitmap_of(some, "h"))
    assert {"3", "77"} <= {r.x for r in kept.collect()} and kept.count() < 20 and kept.columns == ["x", "h"]
    assert _plan(kept).count("xxhash64(") == 1


def test_a_proof_reads_each_release_once(spark):
    cols = ["lei", "income"]
    a = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), (None, "2"), (None, "2"), ("d", "5")], "lei string, income string")
    b = spark.createDataFrame([("a", "1"), ("b", None), ("b", None), (None, "3"), ("d", "5")], "lei string, income string")
    diff = R.multiset_diff(a, b, cols, carry=["lei"]).localCheckpoint()
    proof = R.multiset_proof(a, b, cols, ["lei"], diff)
    assert proof._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 3
    found = {r.lei: (r.exact_left, r.exact_entered, r.hash_left, r.hash_entered, r.agrees) for r in proof.collect()}
    assert found == {"a": (1, 0, 1, 0, True), "b": (0, 1, 0, 1, True), None: (2, 1, 2, 1, True), "d": (0, 0, 0, 0, True)}


def test_plain_headers_are_proved_without_sorting_lines(spark, tmp_path):
    (tmp_path / "plain.csv").write_bytes(b"a,b\n1,2\n\n3,4")
    (tmp_path / "marked.csv").write_bytes(b"\xef\xbb\xbfa,b\r\n1,2\r\n")
    found = L.file_headers(spark, str(tmp_path), ["a", "b"])
    assert "min_by" not in _plan(found)
    assert {(r["file"].rsplit("/", 1)[1], r["lines"], r["problem"]) for r in found.collect()} == {("plain.csv", 3, None), ("marked.csv", 1, None)}
    (tmp_path / "late.csv").write_bytes(b"1,2\na,b\n")
    problems = {r["file"].rsplit("/", 1)[1]: r["problem"] is None for r in L.file_headers(spark, str(tmp_path), ["a", "b"]).collect()}
    assert problems == {"plain.csv": True, "marked.csv": True, "late.csv": False}


def test_the_register_is_staged_narrow_and_published_by_many_tasks(spark, monkeypatch):
    staged = {}

    def noted(df, label):
        staged[label] = df.columns
        return stage(df, label)

    stage = flow_queries.stage
    monkeypatch.setattr(flow_queries, "stage", noted)
    files = flow_queries._files(spark, "/root/testdata/sf0.001", ("snapshot",))
    assert len(staged["flow-register"]) < 20
    for path, *_ in files:
        lines = spark.read.text(path)
        assert lines.first()[0] == ",".join(COLUMNS) and lines.select("_metadata.file_path").distinct().count() > 1


def test_typing_does_not_sort_rows(spark, tmp_path):
    lake = flow.Lake(spark, str(tmp_path / "lake"))
    flow.load_file(lake, write_csv(tmp_path / "a.csv", [row(), row()]), 2021, "snapshot", "a")
    tune(spark)
    rows = flow.judged(lake.raw(), None)
    spark.sql("DROP TABLE IF EXISTS typed_plan")
    rows.createOrReplaceTempView("judged_rows")
    plan = spark.sql(f"EXPLAIN CREATE TABLE typed_plan USING parquet PARTITIONED BY (accepted) LOCATION '{tmp_path}/t' AS SELECT * FROM judged_rows").first()[0]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "2" and "Sort [" not in plan
