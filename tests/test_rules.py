"""Cleaning, typing and validation of single rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from civiclake.functions.labels import mixed_band, numeric_band
from civiclake.functions.numbers import canonical_number, safe_ratio
from civiclake.operators import quality as Q
from civiclake.operators import rules as R
from civiclake.register.rulebook import BOOK, CONSTRAINTS
from civiclake.register.schema import COLUMNS
from civiclake.sources.landing import text_schema
from tests.rows import row


@pytest.fixture(scope="module")
def typed(spark):
    """Typed result per case name (carried in `lei`)."""
    cases = {
        "plain": {},
        "exempt": {"income": "Exempt", "property_value": "Exempt", "reverse_mortgage": "1111"},
        "score 1111": {"applicant_credit_score_type": "1111"},
        "income 1111": {"income": "1111"},
        "reason 1111": {"denial_reason_1": "1111"},
        "exempt elsewhere": {"aus_1": "Exempt"},
        "dti <20": {"debt_to_income_ratio": "<20%"},
        "dti 36": {"debt_to_income_ratio": "36"},
        "dti 44": {"debt_to_income_ratio": "44"},
        "dti 49": {"debt_to_income_ratio": "49"},
        "dti >60": {"debt_to_income_ratio": ">60%"},
        "dti 35": {"debt_to_income_ratio": "35"},
        "dti 50": {"debt_to_income_ratio": "50"},
        "action 9": {"action_taken": "9"},
        "text amount": {"loan_amount": "lots"},
        "wrong year": {"activity_year": "2020"},
        "no year": {"activity_year": "NA"},
        "yesno 3": {"balloon_payment": "3"},
        "reason": {"denial_reason_1": "3"},
        "denied": {"action_taken": "3", "denial_reason_1": "3", "interest_rate": "NA"},
        "rate on denied": {"action_taken": "3"},
        "no state": {"state_code": "NA"},
        "rate": {"interest_rate": "812345"},
        "negative rate": {"interest_rate": "-1"},
        "spread": {"rate_spread": "-7654321"},
        "age 9999": {"applicant_age": "9999"},
        "age 8888": {"applicant_age": "8888"},
        "units 0": {"total_units": "0"},
        "co-applicant": {"co_applicant_sex": "2"},
        "co unknown": {"co_applicant_sex": "NA"},
        "two wrong": {"action_taken": "x", "income": "y"},
        "padded": {"income": "00120", "loan_term": " 85 "},
    }
    rows = [row(**{"lei": name, **changes}) for name, changes in cases.items()]
    df = spark.createDataFrame([(*r, None) for r in rows], text_schema(COLUMNS))
    df = df.withColumns({"year": F.lit(2021), "release": F.lit("snapshot")})
    return {r["lei"]: r for r in R.type_register(df, BOOK, with_raw=True).collect()}


def test_a_plain_row_is_valid(typed):
    r = typed["plain"]
    assert r["reject_reasons"] == "" and r["alerts"] == [] and r["raw_row"] is None
    assert r["loan_amount"] == Decimal("240000.00") and r["interest_rate"] == Decimal("4.25")
    assert r["reverse_mortgage"] is False and r["has_exempt"] is False
    assert r["has_co_applicant"] is False and r["denial_reason_1"] is None
    assert len([c for c in r.asDict() if c not in ("reject_reasons", "raw_row")]) == 62


def test_exempt_is_null_and_flagged(typed):
    r = typed["exempt"]
    assert (r["income"], r["property_value"], r["reverse_mortgage"]) == (None, None, None)
    assert r["has_exempt"] is True and r["reject_reasons"] == ""
    assert typed["score 1111"]["applicant_credit_score_type"] is None
    assert typed["score 1111"]["has_exempt"] is True
    assert typed["income 1111"]["income"] == 1111 and typed["income 1111"]["has_exempt"] is False
    assert typed["reason 1111"]["denial_reason_1"] is None and typed["reason 1111"]["has_exempt"]
    assert typed["exempt elsewhere"]["has_exempt"] is True


@pytest.mark.parametrize(
    "case, band",
    [("dti <20", "<20%"), ("dti 36", "36-40%"), ("dti 44", "40-45%"), ("dti 49", "45-50%"), ("dti >60", ">60%")],
)
def test_dti_bands(typed, case, band):
    assert typed[case]["dti_band"] == band and typed[case]["reject_reasons"] == ""


@pytest.mark.parametrize(
    "case, reasons",
    [
        ("dti 35", "debt_to_income_ratio outside domain"),
        ("dti 50", "debt_to_income_ratio outside domain"),
        ("action 9", "action_taken outside domain"),
        ("text amount", "loan_amount not numeric"),
        ("wrong year", "activity_year differs from the file"),
        ("no year", "activity_year differs from the file"),
        ("yesno 3", "balloon_payment outside domain"),
        ("two wrong", "action_taken outside domain|income not numeric"),
    ],
)
def test_rejections_keep_the_row(typed, case, reasons):
    assert typed[case]["reject_reasons"] == reasons
    assert typed[case]["raw_row"]["lei"] == case


@pytest.mark.parametrize(
    "case, alerts, column, value",
    [
        ("reason", ["reason without denial"], "denial_reason_1", 3),
        ("denied", [], "denial_reason_1", 3),
        ("rate on denied", ["rate without approval"], "action_taken", 3),
        ("no state", ["no state"], "state_code", None),
        ("rate", ["implausible rate"], "interest_rate", Decimal("812345.000")),
        ("negative rate", ["implausible rate"], "interest_rate", Decimal("-1.000")),
        ("spread", ["implausible spread"], "rate_spread", Decimal("-7654321.000")),
        ("age 9999", ["applicant_age 9999"], "applicant_age", None),
        ("age 8888", [], "applicant_age", None),
        ("units 0", ["total_units undocumented"], "total_units", None),
    ],
)
def test_alerts_do_not_reject(typed, case, alerts, column, value):
    r = typed[case]
    assert r["reject_reasons"] == "" and list(r["alerts"]) == alerts and r[column] == value


def test_co_applicant_and_padding(typed):
    assert typed["co-applicant"]["has_co_applicant"] is True
    assert typed["co unknown"]["has_co_applicant"] is None
    assert (typed["padded"]["income"], typed["padded"]["loan_term"]) == (120, 85)


def test_stages_are_not_merged(spark):
    """Three projections stay three, so no value is computed twice, and none uses a lambda."""
    df = spark.createDataFrame([(*row(), None)], text_schema(COLUMNS))
    typed = R.type_register(df.withColumns({"year": F.lit(2021), "release": F.lit("s")}), BOOK)
    plan = typed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project [") == 3 and "lambda" not in plan


def test_write_guard_blocks_a_bad_row(spark, tmp_path):
    good = spark.range(3).selectExpr("cast(id + 1 AS int) AS code", "cast(NULL AS int) AS maybe")
    rules = {"code_valid": "code BETWEEN 1 AND 8", "maybe_valid": "maybe IS NULL OR maybe = 1"}
    Q.guarded(good, rules).write.parquet(str(tmp_path / "ok"))
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 3
    for bad in (good.selectExpr("code + 7 AS code", "maybe"), good.selectExpr("nullif(code, 2) AS code", "maybe")):
        with pytest.raises(Exception, match="check failed: code_valid"):
            Q.guarded(bad, rules).write.mode("overwrite").parquet(str(tmp_path / "bad"))


def test_constraints_accept_valid_typed_rows(spark):
    df = spark.createDataFrame([(*row(), None)], text_schema(COLUMNS))
    typed = R.type_register(df.withColumns({"year": F.lit(2021), "release": F.lit("snapshot")}), BOOK)
    assert Q.domain_violations(typed, CONSTRAINTS).where("violations > 0").count() == 0


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2560.0", "2560"),
        ("2560.00", "2560"),
        ("2.6499999999999999", "2.65"),
        ("2.650", "2.65"),
        ("00120", "120"),
        ("-0.0", "0"),
        ("1e3", "1000"),
        ("100", "100"),
        ("0", "0"),
        ("NA", "NA"),
        ("Exempt", "Exempt"),
        ("123456789012345678901234567890123", "123456789012345678901234567890123"),
        (None, None),
    ],
)
def test_canonical_number(spark, given, expected):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(canonical_number(F.col("t"))).first()[0] == expected


def test_bands_and_ratio(spark):
    df = spark.createDataFrame([(None, 0), (49.9, 9_999_999), (50.0, 1), (1e9, 2)], "v double, n int")
    found = df.select(
        numeric_band(F.col("v"), [50, 75], ["<50", "50-75", "75+"]),
        safe_ratio(F.col("v"), F.col("n"), 1000),
    ).collect()
    assert [r[0] for r in found] == [None, "<50", "50-75", "75+"]
    assert found[0][1] is None and found[3][1] == 500000.0
    with pytest.raises(ValueError):
        numeric_band(F.col("v"), [50], ["only one"])
    texts = spark.createDataFrame([("39",), ("35",), ("low",), (None,)], "t string")
    bands = texts.select(mixed_band(F.col("t"), {"low": "L"}, ((36, 39, "M"),))).collect()
    assert [r[0] for r in bands] == ["M", None, "L", None]
