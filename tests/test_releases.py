"""Releases, manifests, checks and gates."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from civiclake.operators import quality as Q
from civiclake.operators import releases as R
from civiclake.operators.ranking import latest_per_key, top_in_latest, top_per_group
from civiclake.sources import inventory as I
from civiclake.sources import dimensions as D

REGISTRY = "yr int, release string, maturity int, frozen_at date, n bigint"


@pytest.fixture(scope="module")
def registry(spark):
    rows = [
        (2020, "first", 0, date(2021, 5, 3), 10),
        (2020, "middle", 1, date(2022, 4, 30), 12),
        (2020, "final", 2, date(2023, 12, 31), 11),
        (2021, "first", 0, date(2022, 4, 30), 20),
        (2021, "final", 2, date(2022, 4, 30), 21),
        (2022, "first", 0, date(2023, 5, 1), 30),
    ]
    return spark.createDataFrame(rows, REGISTRY)


def _pairs(df):
    return {(r["yr"], r["release"]) for r in df.collect()}


def test_current_and_as_of(spark, registry):
    assert _pairs(R.most_mature(registry, "yr")) == {(2020, "final"), (2021, "final"), (2022, "first")}
    assert _pairs(R.visible_at(registry, "yr", date(2022, 4, 29))) == {(2020, "first")}
    assert _pairs(R.visible_at(registry, "yr", date(2022, 4, 30))) == {(2020, "middle"), (2021, "final")}
    assert _pairs(R.visible_at(registry, "yr", date(2020, 1, 1))) == set()
    table = registry.select("yr", "release", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("i"))
    seen = R.as_of(table, registry, "yr", date(2022, 6, 1)).groupBy("yr").count()
    assert {(r["yr"], r["count"]) for r in seen.collect()} == {(2020, 12), (2021, 21)}


def test_reading_a_release_prunes_partitions(spark, registry, tmp_path, monkeypatch):
    table = registry.select("yr", "release", F.lit(1).alias("x"))
    table.write.partitionBy("yr", "release").parquet(str(tmp_path / "t"))
    stored = spark.read.schema(table.schema).parquet(str(tmp_path / "t"))
    chosen = R.current(stored, registry, "yr")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "final" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert chosen.select("_metadata.file_path").distinct().count() == 3
    monkeypatch.setattr(R, "LISTED_PAIRS", 0)
    joined = R.current(stored, registry, "yr")
    assert joined.exceptAll(chosen).count() == 0 and joined.count() == chosen.count() == 3


def test_publication_order(registry):
    ordered = R.publication_order(registry, "yr").orderBy("position").collect()
    assert [(r["yr"], r["release"]) for r in ordered] == [
        (2020, "first"),
        (2020, "middle"),
        (2021, "first"),
        (2021, "final"),
        (2022, "first"),
        (2020, "final"),
    ]
    assert all(r["takes_effect"] for r in ordered)


def test_scope_plan_and_candidates(spark, registry):
    assert _pairs(R.scope(registry, "yr", (2021,))) == {(2020, "final"), (2021, "first"), (2021, "final"), (2022, "first")}
    applied = registry.where("yr = 2021 AND release = 'final' OR yr = 2020 AND release = 'middle'")
    plan = R.application_plan(registry, applied, "yr")
    found = {(r["yr"], r["release"]): r["action"] for r in plan.collect()}
    assert found == {
        (2020, "first"): "current is more mature",
        (2020, "middle"): "already current",
        (2020, "final"): "apply",
        (2021, "first"): "current is more mature",
        (2021, "final"): "already current",
        (2022, "first"): "apply",
    }
    forced = R.application_plan(registry, applied, "yr", force=True)
    assert forced.where("action <> 'apply'").count() == 0
    nxt = {(r["release"], r["yr"]) for r in R.next_candidates(registry, "yr").collect()}
    assert nxt == {("first", 2023), ("middle", 2021), ("final", 2022)}
    R.check_release(registry, "yr", 2021, "final")
    for year, release in ((2021, "middle"), (2021, "x' OR '1'='1")):
        with pytest.raises(R.UnknownRelease):
            R.check_release(registry, "yr", year, release)


def test_delta(registry):
    delta = {(r["yr"], r["release"]): r["added"] for r in R.release_delta(registry, "yr", "n").collect()}
    assert delta[(2020, "middle")] == 2 and delta[(2020, "final")] == -1 and delta[(2020, "first")] is None


def test_ranking_ties_are_settled(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "c", 9), (2, "a", 1)], "yr int, k string, v int")
    top = top_per_group(df, ["yr"], [F.desc("v"), F.asc("k")], 2).collect()
    assert {(r["yr"], r["k"], r["rank"]) for r in top} == {(1, "c", 1), (1, "a", 2), (2, "a", 1)}
    plan = top_per_group(df, ["yr"], [F.desc("v"), F.asc("k")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert [r["k"] for r in top_in_latest(df, "yr", F.col("v") > 0, [F.desc("v")], 5).collect()] == ["a"]
    assert top_in_latest(df, "yr", F.col("v") > 1, [F.desc("v")], 5).count() == 0
    assert latest_per_key(df, ["yr"], [F.desc("v")]).count() == 2


def test_inventory_states_and_decision(spark):
    mine = spark.createDataFrame([("a", "e1", 1), ("b", "e1", 1), ("c", "e1", 1), ("d", "e1", 1)], "k string, etag string, bytes bigint")
    listing = spark.createDataFrame(
        [("a", "e1", 1, None), ("b", "e2", 1, None), ("c", "e1", 2, None), ("e", "e1", 1, None)],
        "k string, etag string, bytes bigint, error string",
    )
    states = I.inventory_diff(mine, listing, ["k"])
    assert {r["k"]: r["state"] for r in states.collect()} == {
        "a": "equal",
        "b": "republished",
        "c": "republished",
        "d": "not listed",
        "e": "never loaded",
    }
    r = I.decision(states).first()
    assert (r["must_run"], r["decidable"]) == (True, False)
    same = I.inventory_diff(mine.where("k = 'a'"), listing.where("k = 'a'"), ["k"])
    assert I.decision(same).first()["must_run"] is False
    assert I.decision(same, force=True).first()["must_run"] is True
    failed = I.inventory_diff(mine.where("k = 'a'"), listing.where("k = 'a'").withColumn("error", F.lit("timeout")), ["k"])
    assert I.decision(failed).first()["decidable"] is False


def test_pending_loads(spark):
    log = spark.createDataFrame([("a", "h1", 1), ("a", "h2", 2), ("b", "h1", 1)], "k string, hash string, at int")
    now = spark.createDataFrame([("a", "h1"), ("b", "h1"), ("c", "h1")], "k string, hash string")
    pending = I.pending_loads(now, log, ["k"], "hash", "at")
    assert {r["k"] for r in pending.collect()} == {"a", "c"}  # a went back to older content
    assert I.pending_loads(now, log, ["k"], "hash", "at", force=True).count() == 3


def test_precedence_and_lookup(spark):
    old = spark.createDataFrame([("1", "One")], "k string, name string")
    new = spark.createDataFrame([("1", "Uno"), ("2", "Dos")], "k string, name string")
    first = D.with_precedence([old, new], ["k"])
    assert {tuple(r) for r in first.collect()} == {("1", "One"), ("2", "Dos")}
    last = D.with_precedence([old, new], ["k"], last_wins=True)
    assert {tuple(r) for r in last.collect()} == {("1", "Uno"), ("2", "Dos")}
    facts = spark.createDataFrame([("1",), ("3",)], "k string")
    assert D.lookup(facts, first, ["k"], "name").count() == 1
    shown = D.lookup(facts, first, ["k"], "name", F.col("k"))
    assert {r["name"] for r in shown.collect()} == {"One", "3"}


def test_nested_counts(spark):
    doc = '{"DE": {"1": {"n": 3, "total": 1.5}, "3": {"n": 1, "total": 0.5}}, "TX": {"1": {"n": 2, "total": 9}}}'
    df = spark.createDataFrame([(2021, doc)], "yr int, doc string")
    flat = D.flatten_counts(df, "doc", ["state", "outcome"], "struct<n:bigint,total:double>")
    assert {tuple(r) for r in flat.collect()} == {(2021, "DE", "1", 3, 1.5), (2021, "DE", "3", 1, 0.5), (2021, "TX", "1", 2, 9.0)}


def test_reconciliation_finds_missing_cells_on_both_sides(spark):
    kind = "s string, n bigint"
    ours = spark.createDataFrame([("DE", 5), ("TX", 2), ("OK", 1)], kind)
    theirs = spark.createDataFrame([("DE", 6), ("OK", 1), ("WY", 3)], kind)
    found = {r["s"]: r["diff"] for r in Q.mismatches(Q.reconcile(ours, theirs, ["s"], "n")).collect()}
    assert found == {"DE": -1, "TX": 2, "WY": -3}


def test_gate(spark):
    kind = "run_at int, passed boolean"
    changes = spark.createDataFrame([(3,)], "changed_at int")
    good = spark.createDataFrame([(4, False), (5, True), (5, True)], kind)
    Q.require_approval(good, changes)
    for bad, why in (
        (spark.createDataFrame([(5, True), (5, False)], kind), "failures"),
        (spark.createDataFrame([(5, True), (5, None)], kind), "failures"),
        (spark.createDataFrame([(2, True)], kind), "changed"),
        (spark.createDataFrame([], kind), "no checks"),
    ):
        with pytest.raises(Q.NotApproved, match=why):
            Q.require_approval(bad, changes)
