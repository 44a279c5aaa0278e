"""Medians, rates, shares and standardised ratios on hand-built and random rows."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civiclake.operators import quantiles as N
from civiclake.operators.grains import Grain, by_grain, quantiles_by_grain
from civiclake.operators.quantiles import exact_quantiles, value_bucket
from civiclake.operators.rules import type_register
from civiclake.operators.shares import multi_reason_share
from civiclake.operators.standardise import observed_expected
from civiclake.plans import views as V
from civiclake.register import marts as M
from civiclake.register.rulebook import BOOK
from civiclake.register.schema import COLUMNS
from civiclake.sources.landing import text_schema
from tests.rows import row


def _typed(spark, *rows):
    df = spark.createDataFrame([(*r, None) for r in rows], text_schema(COLUMNS))
    return type_register(df.withColumns({"year": F.lit(2021), "release": F.lit("snapshot")}), BOOK)


def test_price_income_and_its_population(spark):
    df = _typed(
        spark,
        row(property_value="300000", income="100"),
        row(property_value="500000", income="100"),
        row(property_value="400000", income="100"),
        row(property_value="9000000", income="100", total_units="5-24"),
        row(property_value="9000000", income="100", reverse_mortgage="1111"),
        row(property_value="9000000", income="0"),
        row(property_value="9000000", income="100", loan_purpose="31"),
        row(property_value="9000000", income="100", action_taken="3", interest_rate="NA"),
        row(property_value="9000000", income="9999999", open_end_line_of_credit="1"),
    )
    found = {r["grain"]: r for r in M.price_income(df).collect()}
    assert set(found) == {"national", "state"}  # a metro needs a hundred purchases
    assert (found["national"]["purchases"], found["national"]["price_income"]) == (3, 4.0)
    assert found["state"]["place"] == "VT" and found["state"]["income_median"] == 100000.0


def test_huge_income_does_not_overflow(spark):
    df = _typed(spark, row(property_value="300000", income="9999999"))
    assert M.price_income(df).first()["price_income"] == pytest.approx(300000 / 9_999_999_000)


def test_market_denials_and_reasons(spark):
    denied = {"action_taken": "3", "interest_rate": "NA"}
    df = _typed(
        spark,
        row(),
        row(interest_rate="5.125", loan_amount="100000"),
        row(action_taken="2"),
        row(**denied, denial_reason_1="1", denial_reason_2="3", denial_reason_3="3"),
        row(**denied, denial_reason_1="1", loan_purpose="31", derived_msa_md="99999"),
        row(action_taken="4", interest_rate="NA"),
        row(loan_purpose="5"),
    )
    market = {r["grain"]: r for r in M.market(df).where("purpose = 'purchase'").collect()}
    assert market["national"]["originations"] == 2
    assert float(market["national"]["volume"]) == 340000.0
    assert market["national"]["rate_median"] == pytest.approx(4.6875)
    rates = {(r["grain"], r["purpose"]): r["denial_rate"] for r in M.denials(df).collect()}
    assert rates[("national", "purchase")] == 0.25 and rates[("national", "refinancing")] == 1.0
    assert ("metro", "refinancing") not in rates and ("metro", "purchase") in rates
    shares = {(r["purpose"], r["reason_name"]): (r["citations"], r["share"]) for r in M.denial_reasons(df).collect()}
    assert shares == {
        ("purchase", "debt-to-income ratio"): (1, 1.0),
        ("purchase", "credit history"): (1, 1.0),
        ("refinancing", "debt-to-income ratio"): (1, 1.0),
    }


def test_disparity_with_equal_profiles(spark):
    """6 of 30 against 12 of 30 denied in one cell: 9 expected each."""
    rows = []
    for race, denied in (("White", 6), ("Black or African American", 12)):
        for i in range(30):
            no = {"action_taken": "3", "interest_rate": "NA"} if i < denied else {}
            rows.append(row(derived_race=race, **no))
    rows += [row(derived_race="Asian", state_code="WY") for _ in range(5)]
    rows += [row(derived_race="Asian", state_code="NA")]
    found = {r["grp"]: r for r in M.disparity(_typed(spark, *rows)).where("dimension = 'race/ethnicity'").collect()}
    assert set(found) == {"White non-Hispanic", "Black"}  # the small cell is not comparable
    white, black = found["White non-Hispanic"], found["Black"]
    assert white["expected"] == pytest.approx(9) and black["expected"] == pytest.approx(9)
    assert white["ratio"] == pytest.approx(6 / 9) and black["ratio"] == pytest.approx(12 / 9)
    assert black["adjusted_rate"] == pytest.approx(0.4) and black["raw_rate"] == pytest.approx(0.4)
    assert black["overall_rate"] == pytest.approx(0.3)
    assert (black["population"], black["comparable"]) == (66, 60)
    assert black["direction"] == "above" and white["direction"] == "below"
    assert not black["publishable"]


def test_race_group_order(spark):
    cases = [
        ("White", "Hispanic or Latino", "Hispanic"),
        ("White", "Not Hispanic or Latino", "White non-Hispanic"),
        ("White", "Ethnicity Not Available", "Not reported"),
        ("Asian", None, "Asian"),
        (None, None, "Not reported"),
    ]
    df = spark.createDataFrame(cases, "race string, eth string, want string")
    assert df.where(M.race_group(F.col("race"), F.col("eth")) != F.col("want")).count() == 0


def test_observed_equals_expected_over_all_groups(spark):
    apps = V.apps(spark, "/root/testdata/sf0.01").withColumn("e", (F.col("outcome") == 3).cast("int"))
    r = observed_expected(apps, "e", {"segment": "ltype", "priority": "purpose"}, ["nation", "place1"], ["yr"], min_cell=5)
    sums = r.groupBy("yr", "dimension").agg(F.sum("observed").alias("o"), F.sum("expected").alias("x"))
    assert sums.where("abs(o - x) > 1e-6").count() == 0


def test_standardisation_never_joins_details(spark):
    apps = V.apps(spark, "/root/testdata/sf0.01").withColumn("e", (F.col("outcome") == 3).cast("int"))
    stored = apps.select("e", "ltype", "nation", "yr")
    result = observed_expected(stored, "e", {"segment": "ltype"}, ["nation"], ["yr"])
    # The only joins are those that build the input view.
    text = result._jdf.queryExecution().executedPlan().toString()
    base = stored._jdf.queryExecution().executedPlan().toString()
    assert text.count("Join") == base.count("Join")


def test_grains_tell_null_places_from_totals(spark):
    df = spark.createDataFrame(
        [(1, "A", "x"), (1, "A", None), (1, None, "99999"), (2, "B", "x")], "yr int, state string, metro string"
    )
    grains = (Grain("all"), Grain("state", "state"), Grain("metro", "metro", exclude=("99999",)))
    found = {(r["yr"], r["grain"], r["place"]): r["n"] for r in by_grain(df, ["yr"], grains, [F.count("*").alias("n")]).collect()}
    assert found == {
        (1, "all", "ALL"): 3,
        (2, "all", "ALL"): 1,
        (1, "state", "A"): 2,
        (2, "state", "B"): 1,
        (1, "metro", "x"): 1,
        (2, "metro", "x"): 1,
    }


def test_reasons_count_once_per_row(spark):
    df = spark.createDataFrame([(1, 5, 5, None), (1, None, 7, 5), (1, None, None, None)], "g int, a int, b int, c int")
    found = {r["reason"]: (r["citations"], r["total"]) for r in multi_reason_share(df, ["g"], ["a", "b", "c"]).collect()}
    assert found == {5: (2, 3), 7: (1, 3)}


numbers = st.one_of(
    st.floats(-1e12, 1e12, allow_nan=False),
    st.sampled_from([0.0, -0.0, 3.125, 1e-9, -1e-9, 5e-324, 1.7e308, -1.7e308]),
)


@pytest.mark.parametrize("few", [10_000, 3, 0])
def test_exact_quantiles_match_numpy(spark, monkeypatch, few):
    """Random groups, one of them hot, with repeated values; also with every bucket cut finer."""
    monkeypatch.setattr(N, "FEW_VALUES", few)
    rng = np.random.default_rng(7)
    rows = [("hot", float(v)) for v in rng.choice([1.5, 2.0, 2.5, 1e6], 400)]
    rows += [("wide", float(v)) for v in rng.lognormal(0, 9, 301)]
    rows += [("mixed", float(v)) for v in rng.normal(0, 1, 200)] + [("one", -3.0), ("none", None)]
    rows += [(None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for q in (0.5, 0.02, 0.9, 0.0, 1.0):
        found = {r["g"]: (r["v"], r["n_v"]) for r in exact_quantiles(df, ["g"], {"v": F.col("v")}, q).collect()}
        assert set(found) == {"hot", "wide", "mixed", "one", None}
        for g, (value, n) in found.items():
            values = [v for k, v in rows if k == g and v is not None]
            assert n == len(values)
            assert value == pytest.approx(float(np.quantile(values, q)), rel=1e-12, abs=1e-300)


def test_a_giant_group_of_nearly_equal_values_is_cut_into_bounded_buckets(spark, monkeypatch):
    """All values within 0.1 %: one bucket of the first level, many of the finer ones."""
    monkeypatch.setattr(N, "FEW_VALUES", 50)
    sizes = []
    stage = N.stage

    def watched(df, label):
        done = stage(df, label)
        if label == "quantile-buckets":
            sizes.append(done.count())
        return done

    monkeypatch.setattr(N, "stage", watched)
    df = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e12 + 5.0).alias("v"), F.when(F.col("id") % 3 > 0, "giant").otherwise("other").alias("g"))
    assert df.select(value_bucket(F.col("v"))).distinct().count() <= 2
    found = {r.g: r for r in exact_quantiles(df, ["g"], {"v": F.col("v")}, {"v": 0.3}).collect()}
    for name, rows in df.toPandas().groupby("g"):
        assert found[name].v == pytest.approx(float(np.quantile(rows.v, 0.3)), rel=1e-15) and found[name].n_v == len(rows)
    assert len(sizes) > 1  # it was refined
    finest = df.groupBy("g", value_bucket(F.col("v"), 2)).count().agg({"count": "max"}).first()[0]
    assert finest < 100


def test_grains_share_one_histogram(spark):
    apps = V.apps(spark, "/root/testdata/sf0.001")
    grains = (Grain("all"), Grain("place", "place1"), Grain("metro", "place2", exclude=("99999",)))
    shared = quantiles_by_grain(apps, ["yr"], grains, {"m": F.col("amount")}, ["purpose"], 0.25)
    rows = apps.select("yr", "purpose", "amount", "place1", "place2").toPandas()
    found = {(r.yr, r.purpose, r.grain, r.place): (r.m, r.n_m) for r in shared.collect()}
    want = {}
    for grain, column in (("all", None), ("place", "place1"), ("metro", "place2")):
        for r in rows[rows.amount.notna()].itertuples():
            place = getattr(r, column) if column else "ALL"
            if place is not None and place != "99999":
                want.setdefault((r.yr, r.purpose, grain, place), []).append(float(r.amount))
    assert set(found) == set(want)
    for key, values in want.items():
        assert found[key] == (pytest.approx(float(np.quantile(values, 0.25)), rel=1e-12), len(values))


def test_quantiles_agree_with_the_builtin(spark):
    apps = V.apps(spark, "/root/testdata/sf0.01")
    ours = exact_quantiles(apps, ["yr", "purpose"], {"m": F.col("amount"), "i": F.col("income")})
    theirs = apps.groupBy("yr", "purpose").agg(F.median("amount").alias("bm"), F.median("income").alias("bi"))
    joined = ours.join(theirs, ["yr", "purpose"])
    assert joined.count() == 35
    assert joined.where("abs(m - bm) > 1e-6 OR abs(i - bi) > 1e-6").count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(numbers, min_size=2, max_size=40))
def test_buckets_keep_the_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = df.select("v", value_bucket(F.col("v")).alias("b")).collect()
    ordered = [r["b"] for r in sorted(found, key=lambda r: r["v"])]
    assert ordered == sorted(ordered)
