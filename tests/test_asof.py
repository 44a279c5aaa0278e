"""The as-of join against a plain search, and the stored partitions it opens."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from civiclake.operators import asof as A
from civiclake.operators import releases as R
from civiclake.plans import release_queries as Q
from civiclake.plans import views as V
from civiclake.sources import publishing as P

SF = "/root/testdata/sf0.001"
START = date(2019, 1, 1)


def brute(rows, history):
    found = []
    for entity, day, *rest in rows:
        known = [h for h in history if entity is not None and day is not None and h[0] == entity and h[1] is not None and h[1] <= day]
        found.append((entity, day, *rest, *(max(known, key=lambda h: h[1:])[2:] if known else (None, None))))
    return sorted(found, key=repr)


@pytest.mark.parametrize("share, least, bucket", [(1024, 100_000, F.year), (5, 40, F.year), (1024, 10, F.month), (10, 30, lambda t: F.lit(0))])
def test_against_a_plain_search(spark, monkeypatch, share, least, bucket):
    """One entity has most rows, one day many of them; buckets without records, ties, nulls, repeated rows."""
    monkeypatch.setattr(A, "HOT_SHARE", share)
    monkeypatch.setattr(A, "HOT_LEAST", least)
    rng = random.Random(share + least)
    spread = 25 if bucket is F.month else 1500  # months only keep the order within a year
    day = lambda: START + timedelta(days=rng.randrange(spread))
    rows = [("hot", START + timedelta(days=20), i % 7) for i in range(150)] + [(rng.choice(["hot", "a", "b", "none"]), day(), i % 3) for i in range(250)]
    rows += [(None, START, 1), ("a", None, 2), rows[3], rows[3]]
    history = [(rng.choice(["hot", "a", "b", "c"]), day(), rng.randrange(3), rng.choice("xyz")) for _ in range(40)] + [(None, START, 1, "x"), ("a", None, 1, "x")]
    history += [("hot", START + timedelta(days=20), 1, "p"), ("hot", START + timedelta(days=20), 1, "q")]
    left = spark.createDataFrame(rows, "who string, `the day` date, level int").repartition(4)
    right = spark.createDataFrame(history, "who string, since date, rank int, value string")
    got = A.as_of_join(left.withColumnsRenamed({"the day": "day"}), right, ["who"], "day", "since", ["rank", "value"], bucket)
    assert got.columns == ["who", "day", "level", "rank", "value"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, history)
    assert A.as_of_join(left.withColumnsRenamed({"the day": "day"}).limit(0), right, ["who"], "day", "since", ["rank", "value"], bucket).count() == 0
    unknown = A.as_of_join(left.withColumnsRenamed({"the day": "day"}), right.limit(0), ["who"], "day", "since", ["rank", "value"], bucket)
    assert unknown.count() == len(rows) and unknown.where("value IS NOT NULL").count() == 0


def test_nothing_is_joined_by_range(spark):
    left = spark.createDataFrame([("a", START)], "who string, day date")
    right = spark.createDataFrame([("a", START, "x")], "who string, since date, value string")
    plan = A.as_of_join(left, right, ["who"], "day", "since", ["value"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_only_visible_partitions_are_opened(spark, tmp_path):
    root, rows = str(tmp_path / "t"), V.released_apps(spark, SF)
    P.publish_all(rows, root, "yr", "release")
    visible = R.visible_at(V.registry(spark, SF), "yr", date(2000, 1, 1))
    stored = R.read_releases(P.read_current(spark, root, rows.schema), visible, "yr")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*release#\d+ = .*yr#\d+ = ", plan)
    opened = {tuple(r) for r in stored.select("yr", "release").distinct().collect()}
    assert opened == {tuple(r) for r in visible.select("yr", "release").collect()}
    assert Q.as_of_date(spark, SF).where("as_of = '2000-01-01'").count() == len(opened)
