"""Query catalogue: populations, grains, medians, rates, shares, standardisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions.labels import code_label, numeric_band, priority_class
from civiclake.functions.numbers import safe_ratio
from civiclake.operators.grains import Grain, by_grain, join_on, quantiles_by_grain
from civiclake.operators.quantiles import exact_quantiles
from civiclake.operators.shares import multi_reason_share, rate, suppress_small
from civiclake.operators.standardise import observed_expected
from civiclake.plans import views as V
from civiclake.sources.scratch import stage

GRAINS = (
    Grain("national", None, "ALL"),
    Grain("state", "place1"),
    Grain("metro", "place2", exclude=("99999",)),
)
PURPOSES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}


def comparable(df: DataFrame) -> DataFrame:
    """Comparable population; an unknown (NULL) flag is left out."""
    return df.where(F.col("closed_end") & (F.col("owner_occupied") == 1) & F.col("units").isin("1", "2", "3", "4"))


def purchases(df: DataFrame) -> DataFrame:
    return comparable(df).where((F.col("outcome") == 1) & (F.col("income") > 0) & (F.col("amount") > 0))


def _six(*names: str) -> dict[str, Column]:
    return {n: F.round(n, 6) for n in names}


def population_filter(spark: SparkSession, folder: str) -> DataFrame:
    apps = V.apps(spark, folder)
    return comparable(apps).groupBy("yr", "outcome").agg(
        F.count("*").alias("n"), F.count_if(F.col("income") > 0).alias("n_income")
    )


def multi_grain(spark: SparkSession, folder: str) -> DataFrame:
    aggs = [F.count("*").alias("n"), F.sum("amount").cast("double").alias("volume")]
    return by_grain(V.apps(spark, folder), ["yr"], GRAINS, aggs)


def _ratio_measures() -> dict[str, Column]:
    return {
        "ratio": safe_ratio(F.col("amount"), F.col("income")),
        "amount_median": F.col("amount"),
        "income_median": F.col("income"),
    }


def _ratio_median(base: DataFrame, time: list[str], grains=GRAINS) -> DataFrame:
    medians = quantiles_by_grain(purchases(base), time, grains, _ratio_measures())
    # The base keeps positive incomes only, so every measure has a value in every row.
    return medians.withColumnRenamed("n_ratio", "n").drop("n_amount_median", "n_income_median")


def ratio_median(spark: SparkSession, folder: str) -> DataFrame:
    result = _ratio_median(V.apps(spark, folder), ["yr"])
    return suppress_small(result, "n", 10, F.col("grain") == "metro").withColumns(
        _six("ratio", "amount_median", "income_median")
    )


def market_volume(spark: SparkSession, folder: str) -> DataFrame:
    base = comparable(V.apps(spark, folder)).where(F.col("outcome") == 1)
    base = base.withColumn("purpose_name", code_label(F.col("purpose"), PURPOSES))
    base = base.where(F.col("purpose_name").isNotNull())
    sums = by_grain(
        base,
        ["yr"],
        GRAINS,
        [F.count("*").alias("n"), F.sum("amount").cast("double").alias("volume")],
        ["purpose_name"],
    )
    rates = quantiles_by_grain(base, ["yr"], GRAINS, {"rate_median": F.col("rate")}, ["purpose_name"])
    both = join_on(sums, rates.drop("n_rate_median"), ["yr", "grain", "place", "purpose_name"])
    return both.withColumns(_six("rate_median"))


def _rates(base: DataFrame, time: list[str], grains=GRAINS) -> DataFrame:
    decided = comparable(base).where(F.col("outcome").isin(1, 2, 3))
    decided = decided.withColumn("purpose_name", code_label(F.col("purpose"), PURPOSES))
    counts = by_grain(
        decided.where(F.col("purpose_name").isNotNull()),
        time,
        grains,
        [F.count("*").alias("decided"), F.count_if(F.col("outcome") == 3).alias("denied")],
        ["purpose_name"],
    )
    return counts.withColumn("denial_rate", rate(F.col("denied"), F.col("decided")))


def rate_by_grain(spark: SparkSession, folder: str) -> DataFrame:
    return _rates(V.apps(spark, folder), ["yr"]).withColumns(_six("denial_rate"))


def min_n_suppression(spark: SparkSession, folder: str) -> DataFrame:
    counts = by_grain(V.apps(spark, folder), ["yr"], GRAINS, [F.count("*").alias("n")], ["ltype"])
    kept = suppress_small(counts, "n", 30, F.col("grain") == "metro")
    return kept.withColumn("publishable", F.col("n") >= 100)


def _with_reasons(spark: SparkSession, folder: str) -> DataFrame:
    exprs = {
        "yr": "cast(year(l_shipdate) as int)",
        "flag": "l_returnflag",
        "r1": "cast(l_partkey % 9 + 1 as int)",
        "r2": "case when l_suppkey % 3 = 0 then cast(l_suppkey % 9 + 1 as int) end",
        "r3": "case when l_orderkey % 5 = 0 then cast(l_partkey % 9 + 1 as int) end",
        "r4": "case when l_linenumber = 4 then 9 end",
    }
    rows = V.table(spark, folder, "lineitem")
    return rows.select(*[F.expr(sql).alias(name) for name, sql in exprs.items()])


REASONS = {1: "debt", 2: "employment", 3: "credit history", 4: "collateral", 5: "cash",
           6: "unverifiable", 7: "incomplete", 8: "insurance"}


def multi_reason_share_query(spark: SparkSession, folder: str) -> DataFrame:
    shares = multi_reason_share(_with_reasons(spark, folder), ["yr", "flag"], ["r1", "r2", "r3", "r4"], "denied")
    named = shares.withColumn("reason_name", code_label(F.col("reason"), REASONS))
    return named.withColumns(_six("share"))


def _value_band() -> Column:
    return numeric_band(F.col("amount"), [100_000, 250_000], ["<100k", "100-250k", "250k+"])


def observed_expected_query(spark: SparkSession, folder: str) -> DataFrame:
    apps = V.apps(spark, folder).select(
        "ltype",
        F.when(F.col("income") < 0, "negative").otherwise("positive").alias("balance"),
        "purpose",
        "nation",
        _value_band().alias("value_band"),
        (F.col("outcome") == 3).cast("int").alias("denied"),
    )
    result = observed_expected(
        apps,
        "denied",
        {"segment": "ltype", "balance": "balance"},
        ["purpose", "nation", "value_band"],
        min_cell=30,
        min_group=1000,
        unpublished=("negative",),
    )
    return result.withColumns(
        _six("expected", "ratio", "overall_rate", "observed_rate", "raw_rate", "adjusted_rate", "raw_ratio")
    )


def _national_metrics(base: DataFrame, time: list[str]) -> DataFrame:
    """Rows, originations, volume, purchase ratio and denial rate per period, in two passes."""
    national = GRAINS[:1]
    in_scope = F.col("closed_end") & (F.col("owner_occupied") == 1) & F.col("units").isin("1", "2", "3", "4")
    decided = F.coalesce(in_scope & F.col("outcome").isin(1, 2, 3) & (F.col("purpose") == "1-URGENT"), F.lit(False))
    sums = base.groupBy(*time).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("outcome") == 1).alias("originated"),
        F.sum(F.when(F.col("outcome") == 1, F.col("amount"))).cast("double").alias("volume"),
        rate(F.count_if(decided & (F.col("outcome") == 3)), F.count_if(decided)).alias("denial_rate"),
    )
    medians = _ratio_median(base, time, national).select(*time, F.col("n").alias("purchases"), "ratio")
    return join_on(sums, medians, time).withColumns(_six("denial_rate", "ratio"))


def metrics_row(spark: SparkSession, folder: str) -> DataFrame:
    return _national_metrics(V.apps(spark, folder), ["yr"])


def release_impact(spark: SparkSession, folder: str) -> DataFrame:
    """The same metrics for every release of a year, in one pass over all releases."""
    metrics = _national_metrics(V.released_apps(spark, folder), ["yr", "release"])
    frozen = V.registry(spark, folder).select("yr", "release", "frozen_at")
    return join_on(metrics, frozen, ["yr", "release"])


def choropleth_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Five equal-width classes between the 2 % quantile and the maximum, one scale for all years."""
    states = stage(_ratio_median(V.apps(spark, folder), ["yr"], (Grain("state", "nation"),)), "state-ratios")
    low = exact_quantiles(states, [], {"low": F.col("ratio")}, 0.02).select("low").scalar()
    high = states.agg(F.max("ratio")).scalar()
    width = F.width_bucket(F.col("ratio"), low, high, F.lit(5))
    return states.select(
        "yr", "place", F.round("ratio", 6).alias("ratio"), F.least(F.greatest(width, F.lit(1)), F.lit(5)).cast("long").alias("bin")
    )


def bands(spark: SparkSession, folder: str) -> DataFrame:
    apps = V.apps(spark, folder)
    rate_band = numeric_band(F.col("rate"), [3, 6, 9], ["<3", "3-6", "6-9", "9+"])
    return apps.groupBy(_value_band().alias("value_band"), rate_band.alias("rate_band")).agg(F.count("*").alias("n"))


def code_label_query(spark: SparkSession, folder: str) -> DataFrame:
    label = code_label(F.col("purpose"), PURPOSES).alias("purpose_name")
    return V.apps(spark, folder).groupBy("purpose", label).agg(F.count("*").alias("n"))


def priority_class_query(spark: SparkSession, folder: str) -> DataFrame:
    apps = V.apps(spark, folder)
    cls = priority_class(
        [
            (F.col("place2") == "99999", "no metro"),
            (F.col("ltype") == "BUILDING", "building"),
            ((F.col("ltype") == "MACHINERY") & F.col("closed_end"), "machinery closed"),
            (F.col("income") < 0, "negative"),
        ],
        "not reported",
    )
    return apps.groupBy(cls.alias("class")).agg(F.count("*").alias("n"))


QUERIES = {
    "population_filter": population_filter,
    "multi_grain": multi_grain,
    "ratio_median": ratio_median,
    "market_volume": market_volume,
    "rate_by_grain": rate_by_grain,
    "min_n_suppression": min_n_suppression,
    "multi_reason_share": multi_reason_share_query,
    "observed_expected": observed_expected_query,
    "metrics_row": metrics_row,
    "release_impact": release_impact,
    "choropleth_bins": choropleth_bins,
    "bands": bands,
    "code_label": code_label_query,
    "priority_class": priority_class_query,
}

_COMPARABLE = "closed_end AND owner_occupied = 1 AND units IN ('1', '2', '3', '4')"
_PURPOSE = (
    "CASE purpose WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' "
    "WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END"
)


def _levels(aggs: str, source: str, dims: str = "") -> str:
    d = f", {dims}" if dims else ""
    return (
        f"SELECT yr, 'national' AS grain, 'ALL' AS place{d}, {aggs} FROM {source} GROUP BY yr{d} UNION ALL "
        f"SELECT yr, 'state', place1{d}, {aggs} FROM {source} WHERE place1 IS NOT NULL GROUP BY yr, place1{d} UNION ALL "
        f"SELECT yr, 'metro', place2{d}, {aggs} FROM {source} WHERE place2 IS NOT NULL AND place2 <> '99999' "
        f"GROUP BY yr, place2{d}"
    )


_RATIO = "cast(amount AS double) / cast(income AS double)"
_RATIO_AGGS = (
    f"count(*) AS n, round(median({_RATIO}), 6) AS ratio, round(median(cast(amount AS double)), 6) AS amount_median, "
    "round(median(cast(income AS double)), 6) AS income_median"
)
_PURCHASES = f"p AS (SELECT * FROM apps WHERE {_COMPARABLE} AND outcome = 1 AND income > 0 AND amount > 0)"
_BAND = "CASE WHEN amount < 100000 THEN '<100k' WHEN amount < 250000 THEN '100-250k' WHEN amount IS NOT NULL THEN '250k+' END"


def _metrics_sql(source: str, keys: str) -> str:
    decided = f"{_COMPARABLE} AND outcome IN (1, 2, 3) AND purpose = '1-URGENT'"
    buying = f"{_COMPARABLE} AND outcome = 1 AND income > 0 AND amount > 0"
    return (
        f"SELECT {keys}, count(*) AS n_rows, count(*) FILTER (outcome = 1) AS originated, "
        "cast(sum(amount) FILTER (outcome = 1) AS double) AS volume, "
        f"round(count(*) FILTER ({decided} AND outcome = 3) / nullif(count(*) FILTER ({decided}), 0), 6) AS denial_rate, "
        f"nullif(count(*) FILTER ({buying}), 0) AS purchases, "
        f"round(median({_RATIO}) FILTER ({buying}), 6) AS ratio FROM {source} GROUP BY {keys}"
    )


_OE = (
    "b AS (SELECT ltype, CASE WHEN income < 0 THEN 'negative' ELSE 'positive' END AS balance, purpose, nation, "
    f"{_BAND} AS value_band, CASE WHEN outcome = 3 THEN 1 ELSE 0 END AS denied FROM apps), "
    "c AS (SELECT purpose, nation, value_band, count(*) AS n_cell, sum(denied) / count(*) AS rate_cell FROM b "
    "GROUP BY 1, 2, 3 HAVING count(*) >= 30), "
    "ok AS (SELECT b.*, rate_cell FROM b JOIN c USING (purpose, nation, value_band)), "
    "d AS (SELECT 'segment' AS dimension, ltype AS grp, denied, rate_cell FROM ok UNION ALL "
    "SELECT 'balance', balance, denied, rate_cell FROM ok), "
    "r AS (SELECT 'segment' AS dimension, ltype AS grp, denied FROM b UNION ALL SELECT 'balance', balance, denied FROM b), "
    "rr AS (SELECT dimension, grp, sum(denied) / count(*) AS raw_rate FROM r GROUP BY 1, 2), "
    "g AS (SELECT sum(denied) / count(*) AS overall_rate, count(*) AS comparable FROM ok), "
    "s AS (SELECT dimension, grp, count(*) AS n, cast(sum(denied) AS bigint) AS observed, sum(rate_cell) AS expected FROM d GROUP BY 1, 2)"
)

ORACLE = {
    "population_filter": "SELECT yr, outcome, count(*) AS n, count(*) FILTER (income > 0) AS n_income "
    f"FROM apps WHERE {_COMPARABLE} GROUP BY yr, outcome",
    "multi_grain": _levels("count(*) AS n, cast(sum(amount) AS double) AS volume", "apps"),
    "ratio_median": f"WITH {_PURCHASES} SELECT * FROM ({_levels(_RATIO_AGGS, 'p')}) WHERE grain <> 'metro' OR n >= 10",
    "market_volume": f"WITH m AS (SELECT *, {_PURPOSE} AS purpose_name FROM apps WHERE {_COMPARABLE} AND outcome = 1), "
    "k AS (SELECT * FROM m WHERE purpose_name IS NOT NULL) "
    + _levels(
        "count(*) AS n, cast(sum(amount) AS double) AS volume, round(median(cast(rate AS double)), 6) AS rate_median",
        "k",
        "purpose_name",
    ),
    "rate_by_grain": f"WITH k AS (SELECT *, {_PURPOSE} AS purpose_name FROM apps WHERE {_COMPARABLE} "
    "AND outcome IN (1, 2, 3) AND purpose <> '4-NOT SPECIFIED') "
    + _levels(
        "count(*) AS decided, count(*) FILTER (outcome = 3) AS denied, "
        "round(count(*) FILTER (outcome = 3) / count(*), 6) AS denial_rate",
        "k",
        "purpose_name",
    ),
    "min_n_suppression": "SELECT *, n >= 100 AS publishable FROM ("
    + _levels("count(*) AS n", "apps", "ltype")
    + ") WHERE grain <> 'metro' OR n >= 30",
    "multi_reason_share": "WITH w AS (SELECT cast(year(l_shipdate) AS int) AS yr, l_returnflag AS flag, "
    "[cast(l_partkey % 9 + 1 AS int), CASE WHEN l_suppkey % 3 = 0 THEN cast(l_suppkey % 9 + 1 AS int) END, "
    "CASE WHEN l_orderkey % 5 = 0 THEN cast(l_partkey % 9 + 1 AS int) END, CASE WHEN l_linenumber = 4 THEN 9 END] AS rs "
    "FROM lineitem), "
    "t AS (SELECT yr, flag, count(*) AS denied FROM w GROUP BY 1, 2), "
    "u AS (SELECT yr, flag, unnest(list_distinct(rs)) AS reason FROM w), "
    "c AS (SELECT yr, flag, reason, count(*) AS citations FROM u GROUP BY 1, 2, 3) "
    "SELECT c.*, denied, round(citations / denied, 6) AS share, CASE reason WHEN 1 THEN 'debt' WHEN 2 THEN 'employment' "
    "WHEN 3 THEN 'credit history' WHEN 4 THEN 'collateral' WHEN 5 THEN 'cash' WHEN 6 THEN 'unverifiable' "
    "WHEN 7 THEN 'incomplete' WHEN 8 THEN 'insurance' END AS reason_name FROM c JOIN t USING (yr, flag)",
    "observed_expected": f"WITH {_OE} SELECT s.dimension, s.grp, n, observed, round(expected, 6) AS expected, "
    "(SELECT count(*) FROM b) AS population, comparable, round(observed / expected, 6) AS ratio, "
    "round(overall_rate, 6) AS overall_rate, round(observed / n, 6) AS observed_rate, round(raw_rate, 6) AS raw_rate, "
    "round(observed / expected * overall_rate, 6) AS adjusted_rate, round(raw_rate / overall_rate, 6) AS raw_ratio, "
    "n >= 1000 AND s.grp <> 'negative' AS publishable, CASE WHEN observed / expected > 1.02 THEN 'above' "
    "WHEN observed / expected < 0.98 THEN 'below' ELSE 'neutral' END AS direction "
    "FROM s JOIN rr USING (dimension, grp), g",
    "metrics_row": _metrics_sql("apps", "yr"),
    "release_impact": f"WITH m AS ({_metrics_sql('released', 'yr, release')}) "
    "SELECT m.*, frozen_at FROM m JOIN registry USING (yr, release)",
    "choropleth_bins": f"WITH {_PURCHASES}, s AS (SELECT yr, nation AS place, median({_RATIO}) AS ratio FROM p GROUP BY 1, 2), "
    "k AS (SELECT quantile_cont(ratio, 0.02) AS low, max(ratio) AS high FROM s) "
    "SELECT yr, place, round(ratio, 6) AS ratio, cast(least(greatest(floor((ratio - low) / ((high - low) / 5)) + 1, 1), 5) AS bigint) AS bin "
    "FROM s, k",
    "bands": f"SELECT {_BAND} AS value_band, CASE WHEN rate < 3 THEN '<3' WHEN rate < 6 THEN '3-6' WHEN rate < 9 THEN '6-9' "
    "WHEN rate IS NOT NULL THEN '9+' END AS rate_band, count(*) AS n FROM apps GROUP BY 1, 2",
    "code_label": f"SELECT purpose, {_PURPOSE} AS purpose_name, count(*) AS n FROM apps GROUP BY 1, 2",
    "priority_class": "SELECT CASE WHEN place2 = '99999' THEN 'no metro' WHEN ltype = 'BUILDING' THEN 'building' "
    "WHEN ltype = 'MACHINERY' AND closed_end THEN 'machinery closed' WHEN income < 0 THEN 'negative' "
    "ELSE 'not reported' END AS class, count(*) AS n FROM apps GROUP BY 1",
}
