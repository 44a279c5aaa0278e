"""Query catalogue: cleaning, typing, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions.labels import mixed_band
from civiclake.functions.numbers import canonical_number
from civiclake.operators import rules as R
from civiclake.operators.rules import Field, Rulebook, text
from civiclake.operators.quality import conservation as conserve
from civiclake.plans import views as V
from civiclake.sources.scratch import new_dir

# Fixed values of the raw view: markers, domains and bands.
MARKERS = ("", "NA", "Exempt")
BANDS = {"<20%": "<20%", "20%-<30%": "20-30%", "30%-<36%": "30-36%", "50%-60%": "50-60%", ">60%": ">60%"}
EXACT = ((36, 39, "36-40%"), (40, 44, "40-45%"), (45, 49, "45-50%"))


def band(value):
    return mixed_band(value, BANDS, EXACT)


BOOK = Rulebook(
    fields=(
        Field("qty_t", "qty", "decimal(18,2)"),
        Field("price_t", "price", "decimal(18,2)"),
        Field("code_t", "code", "code", domain=(1, 2, 3, 4, 5, 6, 7), markers=("1111",)),
        Field("yn_t", "yn", "yesno", markers=("1111",)),
        Field("band_t", "band_text"),
        Field("flag_t", "flag", listed=("A", "N", "R")),
        Field("place_t", "place"),
        Field("rate_t", "rate", "decimal(18,3)"),
        Field("spread_t", "spread", "decimal(18,3)"),
        Field("age_t", "age", listed=("<25", "25-34", "8888", "9999"), not_applicable=("8888", "9999")),
        Field("whole_t", "whole", "whole"),
        Field("reason_t", "reason", "code", domain=(1, 2, 3, 4, 10), not_applicable=(10,), markers=("1111",)),
        Field("co_t", "co", "code", domain=(1, 2, 3, 4, 5, 6)),
        Field("yr_t", "yr_text"),
    ),
    markers=MARKERS,
    flagged=("Exempt",),
    flag="any_exempt",
    keep=("rk", "rl", "pk", "yr"),
    bands={"band": ("band_t", band)},
    rejects=(("year differs from file", "yr_t__text IS NULL OR yr_t__text <> cast(yr AS string)"),),
    alerts=(
        ("reason without denial", "reason <> 10 AND code NOT IN (3, 7)"),
        ("no place", "place IS NULL"),
        ("implausible rate", "rate < 0 OR rate > 30"),
        ("implausible spread", "abs(spread) > 50"),
        ("age 9999", "age = '9999'"),
    ),
    derived={"has_co": "co <> 5"},
)


def _count(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def clean_special(spark: SparkSession, folder: str) -> DataFrame:
    """Values left per column after cleaning, and their total length."""
    cleaned = R.clean(V.raw(spark, folder), BOOK)
    counts = cleaned.groupBy("yr").agg(
        F.count("*").alias("n_rows"),
        *[F.count(text(f.source)).alias(f"{f.source}_n") for f in BOOK.fields],
        *[F.sum(F.length(text(f.source))).alias(f"{f.source}_c") for f in BOOK.fields],
    )
    per_field = [
        F.struct(
            F.lit(f.source).alias("field"),
            F.col(f"{f.source}_n").alias("n_values"),
            F.col(f"{f.source}_c").alias("n_chars"),
        )
        for f in BOOK.fields
    ]
    return counts.select("yr", "n_rows", F.inline(F.array(*per_field)))


def any_marker_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _count(R.clean(V.raw(spark, folder), BOOK), "yr", "any_exempt")


def typed_projection(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = R.clean(V.raw(spark, folder), BOOK)
    return R.apply_types(cleaned, BOOK).groupBy("yr", "yn").agg(
        F.count("*").alias("n"),
        F.count("qty").alias("n_qty"),
        F.sum("qty").cast("double").alias("sum_qty"),
        F.count("price").alias("n_price"),
        F.sum("price").cast("double").alias("sum_price"),
        F.count("code").alias("n_code"),
        F.sum("code").alias("sum_code"),
        F.sum("rate").cast("double").alias("sum_rate"),
        F.sum("spread").cast("double").alias("sum_spread"),
        F.count("whole").alias("n_whole"),
        F.sum("whole").alias("sum_whole"),
    )


def mixed_band_query(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = R.clean(V.raw(spark, folder), BOOK)
    return _count(R.apply_types(cleaned, BOOK), text("band_t").alias("band_text"), "band")


#: Spellings under which one number arrives; the suffix depends on the row.
SPELLED = (
    "case when l_orderkey % 5 = 0 then concat('00', {t}) when l_orderkey % 5 = 1 then concat({t}, '00') "
    "when l_orderkey % 5 = 2 then concat({t}, '000000001') when l_orderkey % 5 = 3 then 'NA' else {t} end"
).format(t="cast(cast(l_extendedprice as decimal(18,2)) as varchar(40))")


def canonical_number_query(spark: SparkSession, folder: str) -> DataFrame:
    spelled = V.table(spark, folder, "lineitem").select(F.expr(SPELLED).alias("t"))
    return _count(spelled.select(canonical_number(F.col("t")).alias("canonical")), "canonical")


def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return _count(R.type_register(V.raw(spark, folder), BOOK), "yr", R.REASONS)


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    typed = R.apply_types(R.clean(V.raw(spark, folder), BOOK), BOOK)
    return R.label_counts(typed, R.alert_rules(BOOK), ["yr"]).withColumnRenamed("label", "alert")


def final_nulling(spark: SparkSession, folder: str) -> DataFrame:
    return _count(
        R.type_register(V.raw(spark, folder), BOOK),
        "flag",
        "age",
        F.col("reason").cast("int").alias("reason"),
        "has_co",
    )


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The raw rows typed once and stored as valid and rejected rows."""
    return R.split_register(V.raw(spark, folder), BOOK, new_dir(spark, "typed"), ["yr"])


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Every rejected row with its reasons and a proof that the raw row is kept."""
    _, rejected = _split(spark, folder)
    return rejected.select(
        "rk",
        "rl",
        F.size(R.REASONS).alias("n_reasons"),
        F.array_join(R.REASONS, "; ").alias("reasons"),
        F.col("raw_row.qty_t").alias("raw_qty"),
        F.col("raw_row.yr_t").alias("raw_yr"),
    )


def silver_table(spark: SparkSession, folder: str) -> DataFrame:
    """The typed table itself: every valid row."""
    valid, _ = _split(spark, folder)
    return valid.select(
        "rk",
        "rl",
        "pk",
        "yr",
        F.col("qty").cast("double").alias("qty"),
        F.col("code").cast("int").alias("code"),
        "yn",
        "band",
        "flag",
        "place",
        F.col("rate").cast("double").alias("rate"),
        "age",
        "whole",
        F.col("reason").cast("int").alias("reason"),
        "has_co",
        "any_exempt",
        F.size("alerts").alias("n_alerts"),
    )


def conservation(spark: SparkSession, folder: str) -> DataFrame:
    """Per year: raw rows = valid + rejected; rejected must be zero for a clean source."""
    valid, rejected = _split(spark, folder)
    return conserve(V.raw(spark, folder), valid, rejected, ["yr"])


QUERIES = {
    "clean_special": clean_special,
    "any_marker_flag": any_marker_flag,
    "typed_projection": typed_projection,
    "mixed_band": mixed_band_query,
    "canonical_number": canonical_number_query,
    "reject_reasons": reject_reasons,
    "alerts": alerts,
    "final_nulling": final_nulling,
    "quarantine": quarantine,
    "silver_table": silver_table,
    "conservation": conservation,
}

_FIELDS = ("qty_t", "price_t", "code_t", "yn_t", "band_t", "flag_t", "place_t", "rate_t", "spread_t",
           "age_t", "whole_t", "reason_t", "co_t", "yr_t")
_WITH_1111 = ("code_t", "yn_t", "reason_t")


def _cleaned(c: str) -> str:
    extra = ", '1111'" if c in _WITH_1111 else ""
    return f"CASE WHEN {c} IN ('', 'NA', 'Exempt'{extra}) THEN NULL ELSE {c} END AS {c}"


_CLEAN = (
    "cleaned AS (SELECT rk, rl, pk, yr, qty_t AS raw_qty, yr_t AS raw_yr, "
    + ", ".join(_cleaned(c) for c in _FIELDS)
    + ", ("
    + " OR ".join(f"{c} = 'Exempt'" for c in _FIELDS)
    + " OR code_t = '1111' OR yn_t = '1111' OR reason_t = '1111') AS any_exempt FROM raw)"
)
_TYPED = _CLEAN + (
    ", tp AS (SELECT *, try_cast(qty_t AS decimal(18,2)) AS qty, try_cast(price_t AS decimal(18,2)) AS price, "
    "try_cast(code_t AS int) AS code, CASE yn_t WHEN '1' THEN true WHEN '2' THEN false END AS yn, "
    "try_cast(rate_t AS decimal(18,3)) AS rate, try_cast(spread_t AS decimal(18,3)) AS spread, "
    "CASE WHEN regexp_full_match(whole_t, '[0-9]+(\\.0+)?') THEN cast(cast(whole_t AS double) AS int) END AS whole, "
    "try_cast(reason_t AS int) AS reason, try_cast(co_t AS int) AS co, "
    "CASE WHEN band_t IN ('<20%', '>60%') THEN band_t WHEN band_t = '20%-<30%' THEN '20-30%' "
    "WHEN band_t = '30%-<36%' THEN '30-36%' WHEN band_t = '50%-60%' THEN '50-60%' "
    "WHEN band_t IN ('36','37','38','39') THEN '36-40%' "
    "WHEN band_t IN ('40','41','42','43','44') THEN '40-45%' "
    "WHEN band_t IN ('45','46','47','48','49') THEN '45-50%' END AS band FROM cleaned)"
)
_REASONS = (
    "concat_ws('|', CASE WHEN yr_t IS NULL OR yr_t <> cast(yr AS varchar) THEN 'year differs from file' END, "
    "CASE WHEN qty_t IS NOT NULL AND qty IS NULL THEN 'qty_t not numeric' END, "
    "CASE WHEN price_t IS NOT NULL AND price IS NULL THEN 'price_t not numeric' END, "
    "CASE WHEN code_t IS NOT NULL AND (code IS NULL OR code NOT BETWEEN 1 AND 7) THEN 'code_t outside domain' END, "
    "CASE WHEN yn_t IS NOT NULL AND yn IS NULL THEN 'yn_t outside domain' END, "
    "CASE WHEN rate_t IS NOT NULL AND rate IS NULL THEN 'rate_t not numeric' END, "
    "CASE WHEN spread_t IS NOT NULL AND spread IS NULL THEN 'spread_t not numeric' END, "
    "CASE WHEN whole_t IS NOT NULL AND whole IS NULL THEN 'whole_t not numeric' END, "
    "CASE WHEN reason_t IS NOT NULL AND (reason IS NULL OR reason NOT IN (1,2,3,4,10)) THEN 'reason_t outside domain' END, "
    "CASE WHEN co_t IS NOT NULL AND (co IS NULL OR co NOT BETWEEN 1 AND 6) THEN 'co_t outside domain' END, "
    "CASE WHEN band_t IS NOT NULL AND band IS NULL THEN 'band_t outside domain' END)"
)
_ALERTS = {
    "reason without denial": "reason <> 10 AND code NOT IN (3, 7)",
    "no place": "place_t IS NULL",
    "implausible rate": "rate < 0 OR rate > 30",
    "implausible spread": "abs(spread) > 50",
    "age 9999": "age_t = '9999'",
    "flag_t undocumented": "flag_t NOT IN ('A', 'N', 'R')",
    "age_t undocumented": "age_t NOT IN ('<25', '25-34', '8888', '9999')",
}
_N_ALERTS = " + ".join(f"coalesce(cast(({test}) AS int), 0)" for test in _ALERTS.values())
_FLAG = "CASE WHEN flag_t IN ('A', 'N', 'R') THEN flag_t END"
_AGE = "CASE WHEN age_t IN ('<25', '25-34') THEN age_t END"
_REASON = "nullif(reason, 10)"

ORACLE = {
    "clean_special": f"WITH {_CLEAN} "
    + " UNION ALL ".join(
        f"SELECT yr, '{c}' AS field, count(*) AS n_rows, count({c}) AS n_values, "
        f"cast(sum(length({c})) AS bigint) AS n_chars FROM cleaned GROUP BY yr"
        for c in _FIELDS
    ),
    "any_marker_flag": f"WITH {_CLEAN} SELECT yr, any_exempt, count(*) AS n FROM cleaned GROUP BY yr, any_exempt",
    "typed_projection": f"WITH {_TYPED} SELECT yr, yn, count(*) AS n, count(qty) AS n_qty, "
    "cast(sum(qty) AS double) AS sum_qty, count(price) AS n_price, cast(sum(price) AS double) AS sum_price, "
    "count(code) AS n_code, cast(sum(code) AS bigint) AS sum_code, cast(sum(rate) AS double) AS sum_rate, "
    "cast(sum(spread) AS double) AS sum_spread, count(whole) AS n_whole, cast(sum(whole) AS bigint) AS sum_whole "
    "FROM tp GROUP BY yr, yn",
    "mixed_band": f"WITH {_TYPED} SELECT band_t AS band_text, band, count(*) AS n FROM tp GROUP BY band_t, band",
    "canonical_number": "WITH s AS (SELECT l_orderkey, l_extendedprice, cast(l_extendedprice AS decimal(18,2)) AS d "
    "FROM lineitem) SELECT CASE WHEN l_orderkey % 5 = 3 THEN 'NA' "
    "ELSE rtrim(rtrim(cast(d AS varchar), '0'), '.') END AS canonical, count(*) AS n FROM s GROUP BY 1",
    "reject_reasons": f"WITH {_TYPED} SELECT yr, {_REASONS} AS reject_reasons, count(*) AS n FROM tp GROUP BY 1, 2",
    "alerts": f"WITH {_TYPED} "
    + " UNION ALL ".join(
        f"SELECT yr, '{label}' AS alert, count(*) AS n FROM tp WHERE {test} GROUP BY yr"
        for label, test in _ALERTS.items()
    ),
    "final_nulling": f"WITH {_TYPED} SELECT {_FLAG} AS flag, {_AGE} AS age, {_REASON} AS reason, co <> 5 AS has_co, "
    "count(*) AS n FROM tp GROUP BY 1, 2, 3, 4",
    "quarantine": f"WITH {_TYPED}, r AS (SELECT *, {_REASONS} AS why FROM tp) "
    "SELECT rk, rl, cast(len(string_split(why, '|')) AS int) AS n_reasons, replace(why, '|', '; ') AS reasons, "
    "raw_qty, raw_yr FROM r WHERE why <> ''",
    "silver_table": f"WITH {_TYPED} SELECT rk, rl, pk, yr, cast(qty AS double) AS qty, code, yn, band, {_FLAG} AS flag, "
    f"place_t AS place, cast(rate AS double) AS rate, {_AGE} AS age, whole, {_REASON} AS reason, co <> 5 AS has_co, "
    f"any_exempt, cast({_N_ALERTS} AS int) AS n_alerts FROM tp WHERE {_REASONS} = ''",
    "conservation": f"WITH {_TYPED} SELECT yr, count(*) AS n_raw, count(*) FILTER ({_REASONS} = '') AS n_valid, "
    f"count(*) FILTER ({_REASONS} <> '') AS n_rejected, true AS conserved, "
    f"count(*) FILTER ({_REASONS} <> '') = 0 AS no_rejects FROM tp GROUP BY yr",
}
