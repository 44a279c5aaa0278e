"""Query catalogue: the loan-application register, derived from the orders, through its rulebook
and marts. The raw view has all published columns as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators import releases as N
from civiclake.operators import revisions as D
from civiclake.operators import rules as R
from civiclake.plans import views as V
from civiclake.register import flow
from civiclake.register import marts as M
from civiclake.register.rulebook import BOOK
from civiclake.register.schema import COLUMNS
from civiclake.sources.landing import CORRUPT
from civiclake.sources.scratch import new_dir, stage

_PRICE = "cast(o_totalprice as decimal(18,2))"
#: Published columns that the orders can fill; the others hold the no-value marker.
FILLED = {
    "activity_year": "cast(year(o_orderdate) + 23 as varchar(10))",
    "lei": "concat('LEI', cast(c_custkey % 97 as varchar(10)))",
    "derived_msa_md": "case when n_nationkey % 5 = 0 then '99999' else concat('M', cast(n_nationkey as varchar(10))) end",
    "state_code": "case when n_nationkey = 23 then 'NA' else concat('S', cast(n_regionkey as varchar(10))) end",
    "conforming_loan_limit": "'C'",
    "derived_ethnicity": "case when c_mktsegment = 'HOUSEHOLD' then 'Hispanic or Latino' else 'Not Hispanic or Latino' end",
    "derived_race": "case c_mktsegment when 'BUILDING' then 'Black or African American' when 'FURNITURE' then 'Asian' "
    "when 'MACHINERY' then 'Race Not Available' else 'White' end",
    "derived_sex": "case c_custkey % 3 when 0 then 'Male' when 1 then 'Female' else 'Joint' end",
    "action_taken": "case when o_orderkey % 499 = 0 then '9' when o_orderstatus = 'O' then '1' when o_orderstatus = 'P' then '2' else '3' end",
    "purchaser_type": "'0'",
    "preapproval": "'2'",
    "loan_type": "case when c_custkey % 10 = 1 then '2' else '1' end",
    "loan_purpose": "case o_orderpriority when '1-URGENT' then '1' when '2-HIGH' then '1' when '3-MEDIUM' then '31' "
    "when '5-LOW' then '32' else '5' end",
    "lien_status": "case when o_orderkey % 17 = 0 then '2' else '1' end",
    "reverse_mortgage": "'2'",
    "open_end_line_of_credit": "case when o_orderkey % 23 = 0 then '1111' when o_orderkey % 29 = 0 then '1' else '2' end",
    "business_or_commercial_purpose": "'2'",
    "loan_amount": f"cast({_PRICE} as varchar(40))",
    "combined_loan_to_value_ratio": "case when o_custkey % 10 = 0 then '92.5' else '75' end",
    "interest_rate": "case when o_orderstatus = 'F' then 'NA' else concat(cast(o_orderkey % 9 as varchar(10)), '.125') end",
    "hoepa_status": "'2'",
    "loan_term": "'360'",
    "negative_amortization": "'2'",
    "interest_only_payment": "'2'",
    "balloon_payment": "'2'",
    "other_nonamortizing_features": "'2'",
    "property_value": f"case when o_orderkey % 41 = 0 then 'Exempt' else cast({_PRICE} + {_PRICE} as varchar(40)) end",
    "construction_method": "case when o_orderkey % 19 = 0 then '2' else '1' end",
    "occupancy_type": "case when o_custkey % 31 = 0 then '2' else '1' end",
    "total_units": "case when o_custkey % 37 = 0 then '5-24' else '1' end",
    "income": "case when c_acctbal < 0 then 'NA' else cast(cast(floor(c_acctbal / 20) as int) as varchar(10)) end",
    "debt_to_income_ratio": "case o_orderkey % 10 when 0 then '44' when 1 then '50%-60%' else '<20%' end",
    "applicant_credit_score_type": "'1'",
    "applicant_sex": "'1'",
    "co_applicant_sex": "'5'",
    "applicant_age": "'35-44'",
    "denial_reason_1": "case when o_orderstatus = 'F' then cast(o_orderkey % 9 + 1 as varchar(10)) else '10' end",
    "denial_reason_2": "case when o_orderstatus = 'F' and o_orderkey % 2 = 0 then cast(o_custkey % 9 + 1 as varchar(10)) else 'NA' end",
}


#: What the published columns are made of.
_SOURCE = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    "c_custkey", "c_mktsegment", "c_acctbal", "n_nationkey", "n_regionkey",
)


def _narrow(spark: SparkSession, folder: str) -> DataFrame:
    t = {n: V.table(spark, folder, n) for n in ("orders", "customer", "nation")}
    return (
        t["orders"]
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select(*_SOURCE)
    )


def _published(narrow: DataFrame) -> DataFrame:
    columns = [F.expr(FILLED.get(c, "'NA'")).alias(c) for c in COLUMNS]
    return narrow.select(
        *columns,
        F.lit(None).cast("string").alias(CORRUPT),
        F.expr("cast(year(o_orderdate) + 23 as int)").alias("year"),
        F.lit("snapshot").alias("release"),
    )


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return _published(_narrow(spark, folder))


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    landed = stage(_raw(spark, folder), "register")
    valid, _ = R.split_register(landed, BOOK, new_dir(spark, "register-typed"), ["year", "release"])
    return valid


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


def register_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and sums over the typed register."""
    return _valid(spark, folder).groupBy("year", "dti_band", "has_exempt").agg(
        F.count("*").alias("n"),
        F.sum("loan_amount").cast("double").alias("loan_amount"),
        F.count("property_value").alias("n_value"),
        F.sum("income").alias("income"),
        F.count_if("open_end_line_of_credit").alias("n_open_end"),
        F.count("denial_reason_1").alias("n_reasons"),
        F.sum(F.size("alerts")).alias("n_alerts"),
    )


def price_income(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(
        M.price_income(_valid(spark, folder)), "price_income", "property_value_median", "income_median"
    )


def market(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(M.market(_valid(spark, folder)), "volume", "rate_median")


def denials(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(M.denials(_valid(spark, folder)), "denial_rate")


def denial_reasons(spark: SparkSession, folder: str) -> DataFrame:
    shares = _rounded(M.denial_reasons(_valid(spark, folder)), "share")
    return shares.withColumn("reason", F.col("reason").cast("int"))


def disparity(spark: SparkSession, folder: str) -> DataFrame:
    """Over all years together, so that even a small register fills its cells."""
    result = M.disparity(_valid(spark, folder), ()).select(
        "dimension", "grp", "n", "observed", "expected", "ratio", "adjusted_rate", "raw_rate",
        "overall_rate", "population", "comparable", "publishable",
    )
    return _rounded(result, "expected", "ratio", "adjusted_rate", "raw_rate", "overall_rate")


def national_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(
        M.national_metrics(_valid(spark, folder)), "originated_volume", "price_income", "purchase_denial_rate"
    )


def respelled_release(spark: SparkSession, folder: str) -> DataFrame:
    """Two releases that differ in spelling, publisher-computed fields and some incomes: only the
    incomes count as changes."""
    before = _raw(spark, folder)
    changed = {
        "loan_amount": F.regexp_replace("loan_amount", "0$", ""),
        "interest_rate": F.when(F.col("interest_rate") == "NA", "NA").otherwise(F.concat("interest_rate", F.lit("000"))),
        "derived_race": F.lit("recomputed"),
        "income": F.when(F.col("lei") == "LEI7", F.concat("income", F.lit("1"))).otherwise(F.col("income")),
    }
    after = before.withColumns(changed)
    a, b = flow.comparable_rows(before), flow.comparable_rows(after)
    diff = D.multiset_diff(a, b, flow.COMPARED, carry=flow.CARRIED)
    return D.entity_rollup(diff, ["lei"])


def application_plan(spark: SparkSession, folder: str) -> DataFrame:
    """What applying every registered release would do where the middle ones are current."""
    registry = V.registry(spark, folder)
    applied = N.most_mature(registry.where("release <> 'final' AND yr < 2000"), "yr")
    return N.application_plan(registry, applied, "yr").select("yr", "release", "action")


def next_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return N.next_candidates(V.registry(spark, folder), "yr")


QUERIES = {
    "register_typed": register_typed,
    "register_price_income": price_income,
    "register_market": market,
    "register_denials": denials,
    "register_denial_reasons": denial_reasons,
    "register_disparity": disparity,
    "register_national_metrics": national_metrics,
    "register_respelled": respelled_release,
    "application_plan": application_plan,
    "next_candidates": next_candidates,
}

_REG = (
    "raw_reg AS (SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in FILLED.items())
    + ", o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey), "
    "reg AS (SELECT cast(activity_year AS int) AS year, lei, derived_msa_md AS msa, nullif(state_code, 'NA') AS st, "
    "cast(action_taken AS int) AS act, cast(loan_purpose AS int) AS purp, cast(loan_type AS int) AS ltype, lien_status = '1' "
    "AND open_end_line_of_credit = '2' AND occupancy_type = '1' AND total_units = '1' AS home, "
    "construction_method = '1' AS site, cast(loan_amount AS decimal(18,2)) AS amount, "
    "cast(nullif(property_value, 'Exempt') AS decimal(18,2)) AS price, cast(nullif(income, 'NA') AS int) AS inc, "
    "cast(combined_loan_to_value_ratio AS decimal(18,3)) AS ltv, cast(nullif(interest_rate, 'NA') AS decimal(18,3)) AS rate, "
    "debt_to_income_ratio AS dti, derived_race, derived_ethnicity, derived_sex AS sex, open_end_line_of_credit AS oe, "
    "property_value = 'Exempt' OR open_end_line_of_credit = '1111' AS exempt, "
    "cast(nullif(denial_reason_1, '10') AS int) AS r1, cast(nullif(denial_reason_2, 'NA') AS int) AS r2 "
    "FROM raw_reg WHERE action_taken <> '9'), "
    "hm AS (SELECT *, CASE purp WHEN 1 THEN 'purchase' WHEN 31 THEN 'refinancing' WHEN 32 THEN 'cash-out refinancing' END AS purpose "
    "FROM reg WHERE home), "
    "buy AS (SELECT * FROM hm WHERE purp = 1 AND site), "
    "pi AS (SELECT *, cast(price AS double) / (cast(inc AS double) * 1000) AS ratio FROM buy WHERE act = 1 AND inc > 0 AND price > 0)"
)
_DTI = "CASE dti WHEN '44' THEN '40-45%' WHEN '50%-60%' THEN '50-60%' ELSE dti END"


def _levels(aggs: str, source: str, dims: str = "") -> str:
    d = f", {dims}" if dims else ""
    return (
        f"SELECT year, 'national' AS grain, 'US' AS place{d}, {aggs} FROM {source} GROUP BY year{d} UNION ALL "
        f"SELECT year, 'state', st{d}, {aggs} FROM {source} WHERE st IS NOT NULL GROUP BY year, st{d} UNION ALL "
        f"SELECT year, 'metro', msa{d}, {aggs} FROM {source} WHERE msa <> '99999' GROUP BY year, msa{d}"
    )


_DISPARITY = (
    "b AS (SELECT st, ltype, CASE WHEN inc < 50 THEN 1 WHEN inc < 75 THEN 2 WHEN inc < 100 THEN 3 WHEN inc < 150 THEN 4 "
    f"WHEN inc < 250 THEN 5 WHEN inc IS NOT NULL THEN 6 END AS ib, {_DTI} AS db, CASE WHEN ltv < 80 THEN 1 ELSE 2 END AS lb, "
    "CASE WHEN amount < 150000 THEN 1 WHEN amount < 250000 THEN 2 WHEN amount < 400000 THEN 3 WHEN amount < 650000 THEN 4 ELSE 5 END AS ab, "
    "CASE WHEN derived_ethnicity = 'Hispanic or Latino' THEN 'Hispanic' WHEN derived_race = 'Black or African American' THEN 'Black' "
    "WHEN derived_race = 'Asian' THEN 'Asian' WHEN derived_race = 'White' THEN 'White non-Hispanic' ELSE 'Not reported' END AS race, sex, "
    "CASE WHEN act = 3 THEN 1 ELSE 0 END AS denied FROM buy WHERE act IN (1, 2, 3)), "
    "ful AS (SELECT * FROM b WHERE st IS NOT NULL AND ib IS NOT NULL), "
    "cl AS (SELECT st, ltype, ib, db, lb, ab, sum(denied) / count(*) AS cell_rate FROM ful GROUP BY ALL HAVING count(*) >= 30), "
    "ok AS (SELECT ful.*, cell_rate FROM ful JOIN cl USING (st, ltype, ib, db, lb, ab)), "
    "ge AS (SELECT sum(denied) / count(*) AS overall_rate, count(*) AS comparable FROM ok), "
    "co AS (SELECT count(*) AS population FROM b), "
    "dm AS (SELECT 'race/ethnicity' AS dimension, race AS grp, denied, cell_rate FROM ok UNION ALL "
    "SELECT 'sex', sex, denied, cell_rate FROM ok), "
    "rw AS (SELECT dimension, grp, sum(denied) / count(*) AS raw_rate FROM (SELECT 'race/ethnicity' AS dimension, race AS grp, denied FROM b "
    "UNION ALL SELECT 'sex', sex, denied FROM b) GROUP BY 1, 2), "
    "su AS (SELECT dimension, grp, count(*) AS n, cast(sum(denied) AS bigint) AS observed, sum(cell_rate) AS expected FROM dm GROUP BY 1, 2)"
)

ORACLE = {
    "register_typed": f"WITH {_REG} SELECT year, {_DTI} AS dti_band, exempt AS has_exempt, count(*) AS n, "
    "cast(sum(amount) AS double) AS loan_amount, count(price) AS n_value, cast(sum(inc) AS bigint) AS income, "
    "count(*) FILTER (oe = '1') AS n_open_end, count(r1) AS n_reasons, "
    "count(*) FILTER (st IS NULL) AS n_alerts FROM reg GROUP BY 1, 2, 3",
    "register_price_income": f"WITH {_REG} SELECT * FROM ("
    + _levels(
        "count(*) AS purchases, round(median(ratio), 6) AS price_income, "
        "round(median(cast(price AS double)), 6) AS property_value_median, "
        "round(median(cast(inc AS double)) * 1000, 6) AS income_median",
        "pi",
    )
    + ") WHERE grain <> 'metro' OR purchases >= 100",
    "register_market": f"WITH {_REG}, k AS (SELECT * FROM hm WHERE act = 1 AND purpose IS NOT NULL) "
    + _levels(
        "count(*) AS originations, round(cast(sum(amount) AS double), 6) AS volume, "
        "round(median(cast(rate AS double)), 6) AS rate_median",
        "k",
        "purpose",
    ),
    "register_denials": f"WITH {_REG}, k AS (SELECT * FROM hm WHERE purpose IS NOT NULL) "
    + _levels(
        "count(*) AS decided, count(*) FILTER (act = 3) AS denied, round(count(*) FILTER (act = 3) / count(*), 6) AS denial_rate",
        "k",
        "purpose",
    ),
    "register_denial_reasons": f"WITH {_REG}, k AS (SELECT * FROM hm WHERE act = 3 AND purpose IS NOT NULL), "
    "t AS (SELECT year, purpose, count(*) AS denied FROM k GROUP BY 1, 2), "
    "u AS (SELECT year, purpose, r1 AS reason FROM k WHERE r1 IS NOT NULL UNION ALL "
    "SELECT year, purpose, r2 FROM k WHERE r2 IS NOT NULL AND r2 IS DISTINCT FROM r1), "
    "c AS (SELECT year, purpose, reason, count(*) AS citations FROM u GROUP BY 1, 2, 3) "
    "SELECT c.year, c.purpose, reason, citations, denied, round(citations / denied, 6) AS share, "
    "['debt-to-income ratio', 'employment history', 'credit history', 'collateral', 'insufficient cash', 'unverifiable information', "
    "'incomplete application', 'mortgage insurance denied', 'other'][reason] AS reason_name FROM c JOIN t USING (year, purpose)",
    "register_disparity": f"WITH {_REG}, {_DISPARITY} SELECT su.dimension, su.grp, n, observed, round(expected, 6) AS expected, "
    "round(observed / expected, 6) AS ratio, round(observed / expected * overall_rate, 6) AS adjusted_rate, round(raw_rate, 6) AS raw_rate, "
    "round(overall_rate, 6) AS overall_rate, population, comparable, n >= 1000 AND su.grp <> 'Not reported' AS publishable "
    "FROM su JOIN rw USING (dimension, grp), ge, co",
    "register_national_metrics": f"WITH {_REG}, p AS (SELECT year, count(*) AS purchases, round(median(ratio), 6) AS price_income FROM pi GROUP BY year), "
    "d AS (SELECT year, round(count(*) FILTER (act = 3) / count(*), 6) AS purchase_denial_rate FROM hm WHERE purp = 1 GROUP BY year) "
    "SELECT reg.year, count(*) AS records, count(*) FILTER (act = 1) AS originated, "
    "round(cast(sum(amount) FILTER (act = 1) AS double), 6) AS originated_volume, any_value(purchases) AS purchases, "
    "any_value(price_income) AS price_income, any_value(purchase_denial_rate) AS purchase_denial_rate "
    "FROM reg LEFT JOIN p USING (year) LEFT JOIN d USING (year) GROUP BY reg.year",
    # Every row of the one lender changes its income unless it has none to spell: 'NA1' is a change too.
    "register_respelled": f"WITH {_REG}, n AS (SELECT lei, count(*) AS k FROM raw_reg GROUP BY lei) "
    "SELECT lei, k AS before, k AS after, CASE lei WHEN 'LEI7' THEN k ELSE 0 END AS entered, "
    "CASE lei WHEN 'LEI7' THEN k ELSE 0 END AS \"left\" FROM n",
    "application_plan": "WITH m AS (SELECT yr, arg_max(release, maturity) AS cur, max(maturity) AS lvl FROM registry "
    "WHERE release <> 'final' AND yr < 2000 GROUP BY yr) "
    "SELECT r.yr, r.release, CASE WHEN cur IS NULL THEN 'apply' WHEN cur = r.release THEN 'already current' "
    "WHEN lvl > r.maturity THEN 'current is more mature' ELSE 'apply' END AS action FROM registry r LEFT JOIN m ON m.yr = r.yr",
    "next_candidates": "SELECT release, cast(max(yr) + 1 AS int) AS yr FROM registry GROUP BY release",
}
