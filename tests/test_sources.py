"""Landing, publishing, catalog, layout and sampling."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from civiclake.operators import sampling as S
from civiclake.operators.quality import guarded
from civiclake.plans import layout as Y
from civiclake.plans import views as V
from civiclake.sources import catalog as C
from civiclake.sources import commits
from civiclake.sources import export as X
from civiclake.sources import landing as L
from civiclake.sources import publishing as P
from civiclake.sources import scratch

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "header, said",
    [
        ("a,b", None),
        ('"a","b"', None),
        ("\ufeffa,b", None),
        ("a,b\r", None),
        ("b,a", "another order"),
        ("a", "absent columns (b)"),
        ("a,b,c", "unknown columns (c)"),
        ("a,b,b", "unknown columns ()"),
    ],
)
def test_headers_of_files(spark, tmp_path, header, said):
    (tmp_path / "one.csv").write_bytes(f"{header}\n1,2\n".encode())
    (tmp_path / "two.csv").write_text("a,b\n1,2\n3,4")
    found = {r["file"].rsplit("/", 1)[1]: (r["lines"], r["problem"]) for r in L.file_headers(spark, str(tmp_path), ["a", "b"]).collect()}
    assert found["two.csv"] == (2, None) and found["one.csv"][0] == 1
    assert found["one.csv"][1] is None if said is None else said in found["one.csv"][1]
    headers = L.file_headers(spark, str(tmp_path), ["a", "b"])
    if said is None:
        assert L.require_headers(headers) == (2, 3)
    else:
        with pytest.raises(L.LoadRefused, match="1 of 2 files.*one.csv"):
            L.require_headers(headers)


def test_lines_are_counted_without_the_parser(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n\n3,4")
    (tmp_path / "two.csv").write_text("a,b\n1,2\n3,4\n")
    lines = L.line_counts(spark, str(tmp_path))
    stored = L.read_text_csv(spark, str(tmp_path), ["a", "b"]).select(F.col("_metadata.file_path").alias("file"))
    found = {r["file"].rsplit("/", 1)[1]: (r["lines"], r["rows"], r["matches"]) for r in L.line_reconciliation(lines, stored).collect()}
    assert found == {"one.csv": (3, 2, False), "two.csv": (2, 2, True)}


def test_partition_replace_and_clear(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2020, "01"), (2, 2020, "02"), (3, 2021, "01")], "x int, yr int, part string")
    assert P.read_current(spark, root, df.schema).count() == 0
    P.publish_all(df, root, "yr", "part")
    assert P.publish(df.where("x = 3"), root, {"yr": 2020, "part": "01"}, counts={"odd": F.col("x") % 2 == 1}) == {"rows": 1, "odd": 1}
    assert P.publish(df.where("x = 9"), root, {"yr": 2020, "part": "02"})["rows"] == 0
    stored = P.read_current(spark, root, df.schema)
    assert {tuple(r) for r in stored.collect()} == {(3, 2020, "01"), (3, 2021, "01")}
    with pytest.raises(ValueError):
        P.publish(df, root, {"yr": "../2020"})
    with pytest.raises(Exception, match="not a plain name"):
        P.publish_all(df.withColumn("part", F.lit("a/b")), root, "yr", "part")
    assert P.read_current(spark, root, df.schema).count() == 2
    P.create_table(df, str(tmp_path / "once"), "yr")
    with pytest.raises(Exception, match="(?i)already exists"):
        P.create_table(df, str(tmp_path / "once"), "yr")


def test_refused_and_failed_writes_keep_the_old_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(5).withColumn("yr", F.lit(1))
    assert P.publish(df, root, {"yr": 1}, 5)["rows"] == 5
    with pytest.raises(L.LoadRefused):
        P.publish(df.limit(2), root, {"yr": 1}, 3)
    with pytest.raises(Exception, match="check failed: small"):
        P.publish(guarded(df, {"small": "id < 4"}), root, {"yr": 1})
    assert sorted(r["id"] for r in P.read_current(spark, root, df.schema).collect()) == list(range(5))


def test_writers_at_once_get_one_order(spark, tmp_path):
    root = str(tmp_path / "t")

    def writes(who):
        for i in range(4):
            df = spark.range(10 * who + i + 1).withColumn("yr", F.lit(1))
            P.publish(df, root, {"yr": 1 if i % 2 else who}, 10 * who + i + 1)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(writes, (1, 2, 3)))
    log = commits.read(spark, f"{root}/{P.VERSIONS}", "place string, version string, rows long").orderBy("commit").collect()
    assert [r.commit for r in log] == list(range(1, 13))
    schema = spark.range(1).withColumn("yr", F.lit(1)).schema
    for at in (*range(1, 13), None):  # every state is readable, and its rows are those of the last commits
        last = {r.place: r.rows for r in log if at is None or r.commit <= at}
        found = {f"yr={r.yr}": r["count"] for r in P.read_current(spark, root, schema, at).groupBy("yr").count().collect()}
        assert found == last


def test_a_number_is_given_once_and_clocks_decide_nothing(spark, tmp_path):
    path = str(tmp_path / "n" / "00007")
    assert commits.create_if_absent(spark, path, "one") and not commits.create_if_absent(spark, path, "two")
    assert Path(path).read_text() == "one" and [p.name for p in (tmp_path / "n").iterdir()] == ["00007"]
    log = str(tmp_path / "log")
    assert commits.read(spark, log, "x long").count() == 0 and commits.last_commit(spark, log) == 0
    rows = spark.createDataFrame([(1,), (2,)], "x long")
    commits.append(rows.withColumn("at", F.lit("2030-01-01")), log)
    commits.append(rows.where("x = 2").withColumn("at", F.lit("1999-01-01")), log)
    rows.withColumn("at", F.lit("x")).write.parquet(f"{log}/entries/entry=unfinished")  # a writer that died before it got a number
    assert sorted(map(tuple, commits.read(spark, log, "x long, at string").collect())) == [(1, "2030-01-01", 1), (2, "1999-01-01", 2), (2, "2030-01-01", 1)]
    assert commits.read(spark, log, "x long", up_to=1).count() == 2


def test_retired_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(i, y) for y in (1, 2) for i in range(4)], "id long, yr int")
    P.publish_all(df, root, "yr")
    for n in (3, 2, 1):
        P.publish(df.where(f"yr = 1 AND id < {n}"), root, {"yr": 1})
    with pytest.raises(L.LoadRefused):
        P.publish(df.where("yr = 1"), root, {"yr": 1}, 99)
    folders = lambda: sum(1 for _ in Path(root).glob("yr=*/version=*"))
    assert folders() == 6 and P.retire(spark, root).count() == 0 and folders() == 6  # all are younger than the grace time
    gone = P.retire(spark, root, keep=[2], grace=timedelta(0)).collect()
    # Of year 1: the versions of commits 1 and 3, and the refused one; commit 2 is still read.
    assert sorted((r.place, r.was_published) for r in gone) == [("yr=1", False), ("yr=1", True), ("yr=1", True)] and folders() == 3
    assert P.read_current(spark, root, df.schema).where("yr = 1").count() == 1
    assert P.read_current(spark, root, df.schema, at=2).where("yr = 1").count() == 3
    assert P.read_current(spark, root, df.schema).where("yr = 2").count() == 4
    assert P.retire(spark, str(tmp_path / "none")).count() == 0


def test_scratch_without_a_named_folder():
    code = (
        "from pyspark.sql import SparkSession\n"
        "from civiclake.sources.scratch import shared_dir, stage\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert shared_dir(spark) == shared_dir(spark) and stage(spark.range(3), 'x').count() == 3\n"
    )
    with tempfile.TemporaryDirectory() as empty:
        home = Path(__file__).resolve().parent.parent
        env = {**os.environ, "SPARK_CONF_DIR": empty, "PYTHONPATH": str(home)}
        subprocess.run([sys.executable, "-c", code], env=env, cwd=empty, check=True, timeout=120)


def test_scratch_uses_the_named_folder(spark):
    assert scratch.new_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    assert scratch.stage(spark.range(10), "x").count() == 10


def test_catalog_and_pruning(spark, tmp_path):
    df = spark.createDataFrame([(y, s) for y in (2020, 2021, 2022) for s in ("DE", "TX")], "yr int, state string")
    P.create_table(P.balanced(df, "yr"), str(tmp_path / "t"), "yr")
    P.create_table(P.balanced(df.where("yr = 2020"), "yr"), str(tmp_path / "old"), "yr")
    C.register_tables(spark, "checked", {"a_table": str(tmp_path / "old")})
    names = C.register_tables(spark, "checked", {"a_table": str(tmp_path / "t"), "other": str(tmp_path / "old")})
    assert set(C.registered(spark, "checked")) >= {"a_table", "other"}
    table = spark.table(names["a_table"])
    assert table.count() == 6 and spark.table(names["other"]).count() == 2
    opened = Y.folders_opened(table, "yr", F.col("yr") >= 2021, F.expr("yr >= 2021 AND state = 'TX'"))
    assert {tuple(r) for r in opened.collect()} == {(2021, 2, 1), (2022, 2, 1)}
    assert [Y.opened(table.where(c).select("state"))[0] for c in ("yr >= 2021", "yr = 2020 AND state = 'TX'", "state = 'TX'")] == [2, 1, 3]
    plan = str(spark.sql(f"EXPLAIN FORMATTED SELECT state FROM {names['a_table']} WHERE yr = 2021").first()[0])
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "yr" in filters and "2021" in filters and "ReadSchema: struct<state:string>" in plan
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_clustering_lets_files_be_skipped_even_with_a_hot_value(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('S', id % 20) END AS state")
    found = {r["layout"]: r.asDict() for r in Y.cluster_experiment(df, "state", "S7", 8, runs=3).collect()}
    assert all(r["seconds"] > 0 for r in found.values())
    assert found["clustered"]["files_overlapping"] < found["shuffled"]["files_overlapping"] == 8
    assert found["clustered"]["n_rows"] == found["shuffled"]["n_rows"] == 4000
    path = str(tmp_path / "c")
    Y.clustered_copy(df, "state", 8, path)
    hot = Y.overlapping(Y.file_ranges(spark.read.parquet(path), "state"), "HOT").first()
    assert hot["files_overlapping"] >= 2 and hot["n_rows"] == 4000  # a third of all rows is split


def test_sample_does_not_depend_on_the_layout(spark):
    apps = V.apps(spark, SF).select("app_id", "yr", "outcome")
    draw = S.hash_draw(["app_id"], seed=7)
    one = S.sample_rows(apps, 0.1, draw)
    other = S.sample_rows(apps.repartition(13, "outcome"), 0.1, draw)
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0
    share = one.count() / apps.count()
    assert 0.08 < share < 0.12
    assert S.sample_rows(apps, 1.0, draw).count() == apps.count()
    for bad in (0, 1.5, -0.1):
        with pytest.raises(ValueError):
            S.sample_rows(apps, bad, draw)
    assert S.public_columns(apps.withColumn("_raw", F.lit(1))).columns == ["app_id", "yr", "outcome"]


def test_extract_has_as_many_files_as_asked(spark, tmp_path):
    df = spark.range(0, 100, 1, 8)
    for files in (1, 4):
        P.write_extract(df, str(tmp_path / str(files)), files)
        assert len(list((tmp_path / str(files)).glob("*.parquet"))) == files
        assert spark.read.parquet(str(tmp_path / str(files))).count() == 100


def test_export_is_plain_json(spark, tmp_path):
    df = spark.sql("SELECT cast(1.50 AS decimal(18,2)) AS d, 1/3D AS x, DATE'2024-01-02' AS day, cast(NULL AS int) AS n")
    X.write_sections({"one": df}, str(tmp_path))
    text = spark.read.text(str(tmp_path / "one")).first()[0]
    assert text == '{"d":1.5,"x":0.333333,"day":"2024-01-02","n":null}'
