"""The register from file to export, on hand-built rows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from civiclake.operators.quality import NotApproved
from civiclake.register import flow
from civiclake.register.flow import Lake
from civiclake.register.schema import COLUMNS
from civiclake.sources import publishing as P
from civiclake.sources.landing import LoadRefused
from tests.rows import row, write_csv

FROZEN = {"snapshot": date(2022, 4, 30), "one_year": date(2023, 5, 1), "three_year": date(2024, 12, 31)}


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def _load(lake, tmp_path, rows, release="snapshot", year=2021, tag="a", **options):
    path = write_csv(tmp_path / f"{release}-{tag}.csv", rows, **options)
    return flow.load_file(lake, path, year, release, tag)


def test_load_keeps_every_line_and_is_idempotent(lake, tmp_path):
    short, long = row()[:50], [*row(), "extra"]
    rows = [row(), row(), short, long]
    assert _load(lake, tmp_path, rows, final_newline=False) == "loaded"
    assert _load(lake, tmp_path, rows) == "unchanged"
    stored = lake.raw()
    assert stored.count() == 4
    assert stored.where("_corrupt_line IS NOT NULL").count() == 2
    assert stored.where("release = 'snapshot' AND year = 2021").count() == 4
    assert lake.log("load_log", flow.LOAD_LOG).count() == 1


def test_republished_file_replaces_only_its_partition(lake, tmp_path):
    _load(lake, tmp_path, [row(), row()])
    _load(lake, tmp_path, [row()], release="one_year")
    assert _load(lake, tmp_path, [row()] * 3, tag="b") == "loaded"
    counts = {r["release"]: r["n"] for r in lake.raw().groupBy("release").agg(F.count("*").alias("n")).collect()}
    assert counts == {"snapshot": 3, "one_year": 1}


@pytest.mark.parametrize(
    "header, said",
    [
        ([COLUMNS[1], COLUMNS[0], *COLUMNS[2:]], "another order"),
        ([*COLUMNS[:-1], "new_column"], "new_column"),
    ],
)
def test_wrong_header_refuses_the_load(lake, tmp_path, header, said):
    with pytest.raises(LoadRefused, match=said):
        _load(lake, tmp_path, [row()], header=header)


def test_blank_line_refuses_the_load_and_keeps_the_old_data(lake, tmp_path):
    _load(lake, tmp_path, [row(), row()])
    with pytest.raises(LoadRefused):
        _load(lake, tmp_path, [row(), [""], row(), row()], tag="b")
    assert lake.raw().count() == 2


@pytest.mark.parametrize("year, release", [(2021, "x' OR 1=1"), (2017, "snapshot"), ("2021", "snapshot")])
def test_unknown_sources_are_refused(lake, year, release):
    with pytest.raises(ValueError):
        flow.load_file(lake, "any.csv", year, release, "hash")


def test_more_mature_release_becomes_current(lake, tmp_path):
    _load(lake, tmp_path, [row()] * 3)
    _load(lake, tmp_path, [row()] * 5, release="three_year")
    assert flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"]) == "current"
    assert flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"]) == "unchanged"
    assert lake.current().count() == 3
    assert flow.apply_release(lake, 2021, "three_year", FROZEN["three_year"]) == "current"
    assert lake.current().count() == 5
    assert flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"]) == "unchanged"
    assert lake.typed().count() == 8
    # Forced, the year goes back to the less mature release; the other one stays for reads as of a day.
    assert flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"], force=True) == "current"
    assert lake.current().count() == 3 and lake.typed().count() == 8
    assert lake.as_of(date(2024, 12, 31)).count() == 5
    with pytest.raises(ValueError):
        flow.apply_release(lake, 2022, "snapshot", FROZEN["one_year"])


def test_late_older_release_is_stored_for_reads_as_of_a_day(lake, tmp_path):
    paths = {
        release: write_csv(tmp_path / f"{release}.csv", [row()] * n) for release, n in (("snapshot", 2), ("three_year", 4))
    }
    late = (paths["snapshot"], 2021, "snapshot", "s", FROZEN["snapshot"])
    first = (paths["three_year"], 2021, "three_year", "t", FROZEN["three_year"])
    assert flow.run_scope(lake, [first]) == [(2021, "three_year", "loaded", "current")]
    assert flow.run_scope(lake, [first, late]) == [
        (2021, "snapshot", "loaded", "stored"), (2021, "three_year", "unchanged", "unchanged"),
    ]
    assert lake.current().count() == 4
    assert lake.as_of(date(2023, 1, 1)).count() == 2
    assert lake.as_of(date(2020, 1, 1)).count() == 0


def test_broken_constraint_keeps_rows_and_registry(lake, tmp_path, monkeypatch):
    _load(lake, tmp_path, [row()] * 3)
    flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"])
    monkeypatch.setattr(flow, "CONSTRAINTS", {"no state": "state_code IS NULL"})
    with pytest.raises(LoadRefused, match="check failed: no state"):
        flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"], force=True)
    assert lake.current().count() == 3 and lake.log("registry", flow.REGISTRY).count() == 1


def test_lost_partition_fails_the_checks(lake, spark, tmp_path):
    _load(lake, tmp_path, [row()] * 3)
    _load(lake, tmp_path, [row(activity_year="2022")] * 2, year=2022)
    for year in (2021, 2022):
        flow.apply_release(lake, year, "snapshot", FROZEN["snapshot"])
    P.publish(lake._judged().where("year = 0").drop("year", "release"), lake.path("typed"), {"year": 2022, "release": "snapshot"}, inner=["accepted"])
    found = {(r["year"], r["check_name"]): r["passed"] for r in flow.run_checks(lake).collect()}
    assert found[2021, "single release"] and found[2021, "conservation"]
    assert not found[2022, "single release"] and not found[2022, "conservation"]


def test_rejected_rows_are_kept_with_reasons(lake, tmp_path):
    _load(lake, tmp_path, [row(), row(action_taken="9"), row(activity_year="2020")])
    flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"])
    rejected = {r["raw_row"]["action_taken"]: list(r["reject_reasons"]) for r in lake.rejected().collect()}
    assert rejected == {
        "9": ["action_taken outside domain"],
        "1": ["activity_year differs from the file"],
    }
    assert lake.current().count() == 1
    # A clean republication clears the rejects of the partition.
    _load(lake, tmp_path, [row()], tag="b")
    flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"], force=True)
    assert lake.rejected().count() == 0 and lake.current().count() == 1


def _official(spark, n):
    return spark.createDataFrame([(2021, "VT", "1", n), (2021, "VT", "3", 1)], "year int, state_code string, action_taken string, n bigint")


def test_checks_gate_marts_and_export(lake, spark, tmp_path):
    rows = [row(income=str(50 + i), lei="L%d" % (i % 3)) for i in range(4)]
    rows.append(row(action_taken="3", interest_rate="NA", denial_reason_1="1", denial_reason_2="3"))
    _load(lake, tmp_path, rows)
    _load(lake, tmp_path, [*rows[1:], row(income="99", lei="L0")], release="three_year")
    flow.apply_release(lake, 2021, "snapshot", FROZEN["snapshot"])
    with pytest.raises(NotApproved, match="no checks"):
        flow.build_marts(lake)

    lenders = spark.createDataFrame([(2021, "L0", 2), (2021, "L1", 1), (2021, "L2", 1)], "year int, lei string, n bigint")
    found = flow.run_checks(lake, _official(spark, 5), lenders)
    failed = {r["check_name"] for r in found.where("NOT passed").collect()}
    assert failed == {"official counts", "lenders"}  # off by one; one lender is not listed
    detail = found.where("check_name = 'official counts'").first()["detail"]
    assert detail == "2 cells, 1 differ VT 1 -1"
    with pytest.raises(NotApproved, match="failures"):
        flow.build_marts(lake)

    found = flow.run_checks(lake, _official(spark, 4))
    assert found.where("NOT passed").count() == 0
    flow.build_marts(lake)
    prices = spark.read.parquet(lake.path("marts/price_income"))
    national = prices.where("grain = 'national'").first()
    assert national["purchases"] == 4 and national["income_median"] == 51500.0
    assert prices.where("grain = 'metro'").count() == 0  # fewer than the minimum

    flow.apply_release(lake, 2021, "three_year", FROZEN["three_year"])
    with pytest.raises(NotApproved, match="changed"):
        flow.build_marts(lake)
    flow.run_checks(lake, _official(spark, 4))
    flow.build_marts(lake)
    impact = {r["release"]: r["records"] for r in spark.read.parquet(lake.path("marts/impact")).collect()}
    assert impact == {"snapshot": 5, "three_year": 5}

    flow.compare_releases(lake, 2021, "snapshot", "three_year", "VT")
    summary = spark.read.parquet(lake.path("revisions/summary")).first()
    assert (summary["before"], summary["after"], summary["entered"], summary["left"]) == (5, 5, 1, 1)
    assert [(r["field"], r["pairs"]) for r in spark.read.parquet(lake.path("revisions/fields")).collect()] == [("income", 1)]

    metros = spark.createDataFrame([("15540", "Burlington")], "place string, name string")
    names = spark.createDataFrame([("L0", "First Bank")], "lei string, name string")
    flow.export(lake, str(tmp_path / "export"), metros, names)
    top = spark.read.json(str(tmp_path / "export" / "top_lenders"))
    assert {(r["lei"], r["name"], r["moved"]) for r in top.collect()} >= {("L0", "First Bank", 2), ("L1", "L1", 0)}


def test_comparison_refuses_a_wrong_pair(lake):
    with pytest.raises(ValueError):
        flow.compare_releases(lake, 2021, "three_year", "snapshot", None)
    with pytest.raises(ValueError):
        flow.compare_releases(lake, 2021, "snapshot", "final'; --", None)


def test_all_pairs_come_from_one_tally_and_are_proved_before_they_are_published(lake, tmp_path, monkeypatch):
    for n, release in enumerate(("snapshot", "one_year", "three_year")):
        _load(lake, tmp_path, [row(income=str(50 + i)) for i in range(3)] + [row(income="99")] * n, release=release)
    proof = flow.R.multiset_proof
    monkeypatch.setattr(flow.R, "multiset_proof", lambda *a: proof(*a).withColumn("agrees", F.lit(False)))
    with pytest.raises(flow.ProofFailed):
        flow.compare_all(lake, [2021], "VT")
    assert not (tmp_path / "lake" / "revisions").exists()
    monkeypatch.setattr(flow.R, "multiset_proof", proof)
    calls, tally = [], flow.R.tally
    monkeypatch.setattr(flow.R, "tally", lambda *a, **k: calls.append(a) or tally(*a, **k))
    flow.compare_all(lake, [2021], "VT")
    found = {(r.from_release, r.to_release): (r.before, r.after, r.entered, r.left) for r in lake.table("revisions/summary").collect()}
    assert found == {("snapshot", "one_year"): (3, 4, 1, 0), ("snapshot", "three_year"): (3, 5, 2, 0), ("one_year", "three_year"): (4, 5, 1, 0)}
    assert len(calls) == 1
