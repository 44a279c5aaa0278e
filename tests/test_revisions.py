"""Change detection on small releases, and its paths for big ones."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from civiclake.functions.fingerprint import row_fingerprint, row_text
from civiclake.operators import digests as D
from civiclake.operators import revisions as R
from civiclake.plans import views as V
from civiclake.register import flow
from civiclake.register.schema import COLUMNS, COMPARED
from tests.rows import row

SCHEMA = "lei string, income string, amount string"
SF = "/root/testdata/sf0.01"


def _release(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _totals(before, after, columns=("lei", "income", "amount")):
    r = R.pair_summary(R.multiset_diff(before, after, columns)).first()
    return r["left"], r["entered"], r["same"]


def test_copies_are_counted_not_removed(spark):
    before = _release(spark, [("a", "1", "x")] * 2 + [("b", "1", "x")])
    after = _release(spark, [("a", "1", "x")] + [("b", "1", "x")] * 2 + [("c", "1", "x")])
    assert _totals(before, after) == (1, 2, 2)


def test_null_keeps_its_place(spark):
    before = _release(spark, [(None, "x", "1")])
    after = _release(spark, [("x", None, "1")])
    assert _totals(before, after) == (1, 1, 0)
    df = before.unionByName(after)
    cols = ["lei", "income", "amount"]
    assert df.select(*row_fingerprint(cols)).distinct().count() == 2
    assert df.select(row_text(cols)).distinct().count() == 2


def test_separator_inside_a_value_is_no_boundary(spark):
    df = _release(spark, [("a\u001fb", "c", "1"), ("a", "b\u001fc", "1")])
    assert df.select(*row_fingerprint(["lei", "income", "amount"])).distinct().count() == 2


def test_single_field_corrections(spark):
    before = _release(spark, [("a", "85", "105"), ("b", "85", "105"), ("c", "1", "1"), ("d", "2", "2")])
    after = _release(spark, [("a", "95", "105"), ("b", "85", "155"), ("c2", "1", "1"), ("d", "3", "9")])
    cols = ["lei", "income", "amount"]
    pairs = {r["field"]: r["pairs"] for r in R.attribute_fields(R.weighted_changes(before, after, cols), cols).collect()}
    # The corrected identifier is found too; the row with two corrected fields pairs with none.
    assert pairs == {"lei": 1, "income": 1, "amount": 1}


def test_pairs_follow_multiplicity(spark):
    before = _release(spark, [("a", "1", "x")] * 5)
    after = _release(spark, [("a", "2", "x")] * 3 + [("a", "3", "x")] * 4)
    cols = ["lei", "income", "amount"]
    found = R.attribute_fields(R.weighted_changes(before, after, cols), cols).collect()
    assert [(r["field"], r["pairs"]) for r in found] == [("income", 5)]


def test_columns_are_halved_before_rows_are_expanded(spark, monkeypatch):
    """On 86 columns: the same pairs as by single fields, and few of the (row, field) combinations."""
    rng = random.Random(5)
    columns = [f"c{i}" for i in range(86)]
    make = lambda: [rng.choice("ab") + str(rng.randrange(10**6)) if i % 3 else None for i in range(86)]
    old, new, want = [], [], Counter()
    for n in range(120):
        a, b = make(), make()
        if n < 40:
            b, at = list(a), rng.randrange(86)
            b[at] = "corrected"
            want[columns[at]] += 1
        elif n < 60:  # two fields: no pair
            b = list(a)
            b[3], b[70] = "corrected", "corrected"
        old.append((*a, 0, 1))
        new.append((*b, 1, 0))
    schema = ", ".join(f"{c} string" for c in columns) + ", entered long, `left` long"
    changes = spark.createDataFrame(old + new, schema)
    sizes, filtered = [], R.within

    def watched(df, *rest):
        found = filtered(df, *rest)
        sizes.append((df.count(), found.count()))
        return found

    monkeypatch.setattr(R, "within", watched)
    found = {r["field"]: r["pairs"] for r in R.attribute_fields(changes, columns).collect()}
    assert found == want
    assert len(sizes) == 4 and sizes[0][0] == 480 and sum(n for n, _ in sizes) + 6 * sizes[-1][1] < 240 * 86 / 10
    monkeypatch.setattr(R, "HALVED_TO", 86)
    assert {r["field"]: r["pairs"] for r in R.attribute_fields(changes, columns).collect()} == want
    monkeypatch.setattr(R, "HALVED_TO", 1)
    by = changes.withColumn("g", F.when(F.col("c1") < "b", 1))
    few = {(r["g"], r["field"]): r["pairs"] for r in R.attribute_fields(by, columns, ["g"]).collect()}
    assert sum(few.values()) >= sum(want.values()) - want["c1"] and {k[0] for k in few} == {1, None}


def _random_rows(seed, n):
    rng = random.Random(seed)
    hot = [("hot", "1", "1")] * (n // 3)
    return hot + [(rng.choice("abc"), str(rng.randint(1, 4)), rng.choice([None, "1", "2"])) for _ in range(n - len(hot))]


@pytest.mark.parametrize("bits, levels", [(27, (0, 12, 24)), (16, (0, 2)), (15, ())])
def test_changed_rows_equal_the_bag_difference(spark, monkeypatch, bits, levels):
    """With few bits nearly every row shares a bit with a changed one; without levels nothing is left out early."""
    monkeypatch.setattr(D, "RANGE_BITS", bits)
    monkeypatch.setattr(D, "LEVELS", levels)
    monkeypatch.setattr(R, "COPIES_PER_ROW", 7)
    a, b = _random_rows(1, 300), _random_rows(2, 120)
    before, after = _release(spark, a), _release(spark, b)
    cols = ["lei", "income", "amount"]
    for entity in ((), ["lei"]):
        left = Counter(tuple(r) for r in R.changed_rows(before, after, cols, "left", entity).collect())
        entered = Counter(tuple(r) for r in R.changed_rows(before, after, cols, "entered", entity).collect())
        assert left == Counter(a) - Counter(b)
        assert entered == Counter(b) - Counter(a)
    taken = Counter(tuple(r) for r in R.multiset_take(before, cols, 9).collect())
    assert taken == Counter({k: min(n, 9) for k, n in Counter(a).items()})


def test_equal_releases_and_empty_ones(spark):
    cols = ["lei", "income", "amount"]
    rows, none = _release(spark, _random_rows(3, 50)), _release(spark, []).limit(0)
    for before, after, left, entered in ((rows, rows, 0, 0), (rows, none, 50, 0), (none, rows, 0, 50), (none, none, 0, 0)):
        assert R.changed_rows(before, after, cols, "left", ["lei"]).count() == left
        assert R.changed_rows(before, after, cols, "entered", ["lei"]).count() == entered


def test_digests_prove_entities_and_ranges_unchanged(spark):
    cols = ["lei", "income", "amount"]
    rows = [(f"lender {i % 40}", str(i), "x") for i in range(4000)]
    before = _release(spark, rows)
    after = _release(spark, rows[3::-1] + rows[4:77] + [("lender 7", "corrected", "x")] + rows[78:] + [rows[9]] * 2)
    prints = D.changed_prints(*(D.release_prints(df, cols, entity=["lei"]) for df in (before, after)))
    # Lenders 37 (lost a row), 7 (won one) and 9 (two more copies) differ, and in them only the ranges of these rows.
    assert prints.count() < 40
    net = prints.groupBy("h1", "h2").agg(F.sum("weight").alias("net")).where("net <> 0")
    assert sorted(r.net for r in net.collect()) == [-1, 1, 2]
    # One row twice and another not at all is not the same bag, though lengths agree.
    swapped = _release(spark, rows[1:] + rows[1:2])
    narrow = [D.release_prints(df, cols, entity=["lei"]) for df in (before, swapped)]
    assert D.changed_prints(*narrow).count() > 0


def test_bitmaps_hold_their_hashes(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h"))
    bitmap = D.bitmap_of(hashes.where("h % 3 = 0"), "h")
    kept = D.within(hashes, F.col("h"), bitmap)
    assert hashes.where("h % 3 = 0").exceptAll(kept).count() == 0
    assert kept.where("h % 3 <> 0").count() < 40  # one in 128, or fewer
    edges = spark.createDataFrame([(0,), (-1,), (2**63 - 1,), (-(2**63),)], "h long")
    assert D.within(edges, F.col("h"), D.bitmap_of(edges, "h")).count() == 4
    assert D.within(edges, F.col("h"), D.bitmap_of(edges.limit(0), "h")).count() == 0


def test_full_rows_move_only_after_the_bitmap(spark):
    a, b = V.rel(spark, SF, "a"), V.rel(spark, SF, "b")
    plan = R.weighted_changes(a, b, V.COMPARED, entity=["sk"])._jdf.queryExecution().executedPlan().toString()
    moves = [m.split("FileScan") for m in plan.split("Exchange hashpartitioning")[1:]]
    # What moves is rows that passed the bitmap, or the changed fingerprints.
    assert moves and all("LeftSemi" in m[0] or "_k_h1" in m[1] for m in moves)


def _register(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in COLUMNS))


def test_respelled_and_computed_fields_are_no_change(spark):
    before = _register(
        spark,
        row(loan_amount="2560.0", interest_rate="2.6499999999999999", income="120"),
        row(tract_population="4000", derived_race="White"),
    )
    after = _register(
        spark,
        row(loan_amount="2560.00", interest_rate="2.650", income="00120"),
        row(tract_population="4111", derived_race="Asian"),
    )
    assert len(COMPARED) == 86
    a, b = flow.comparable_rows(before), flow.comparable_rows(after)
    assert _totals(a, b, COMPARED) == (0, 0, 2)
    c = flow.comparable_rows(_register(spark, row(income="95"), row(loan_amount="155000.0")))
    d = flow.comparable_rows(_register(spark, row(income="85"), row(loan_amount="105000.0")))
    pairs = {r["field"]: r["pairs"] for r in R.attribute_fields(R.weighted_changes(c, d, COMPARED), COMPARED).collect()}
    assert pairs == {"income": 1, "loan_amount": 1}


def test_all_pairs_agree_with_single_comparisons(spark):
    names = ("a", "b", "c")
    releases = {n: V.rel(spark, SF, n) for n in names}
    counted = R.tally(R.tag_releases(releases, V.COMPARED), names, V.COMPARED)
    found = {(r["from_release"], r["to_release"]): (r["left"], r["entered"], r["same"]) for r in R.all_pairs(counted, names).collect()}
    for (x, y), totals in found.items():
        assert totals == _totals(releases[x], releases[y], V.COMPARED)
    assert len(found) == 3


def test_proof_disagrees_when_rows_are_hidden(spark, monkeypatch):
    a, b = _release(spark, [("a", "1", "x")]), _release(spark, [("a", "2", "x")])
    cols = ["lei", "income", "amount"]
    assert R.multiset_proof(a, b, cols, ["lei"]).first()["agrees"] is True
    monkeypatch.setattr(R, "row_fingerprint", lambda c: (F.lit(0).alias("h1"), F.lit(0).alias("h2")))
    assert R.multiset_proof(a, b, cols, ["lei"]).first()["agrees"] is False
