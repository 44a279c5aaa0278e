"""Query catalogue: domain checks, reconciliation, tolerance, gate, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators import quality as Q
from civiclake.operators import releases as R
from civiclake.operators.sampling import sample_rows
from civiclake.plans import views as V
from civiclake.sources.publishing import append_log
from civiclake.sources.scratch import new_dir

RULES = {
    "year_valid": "yr >= 1996",
    "outcome_valid": "outcome BETWEEN 1 AND 2",
    "rate_valid": "rate IS NULL OR rate BETWEEN 0 AND 12",
    "income_valid": "income >= 0",
    "flag_known": "closed_end",
}


def domain_checks(spark: SparkSession, folder: str) -> DataFrame:
    return Q.domain_violations(V.apps(spark, folder), RULES, ["yr"])


def null_audit(spark: SparkSession, folder: str) -> DataFrame:
    return Q.null_audit(V.apps(spark, folder), ["entity", "outcome", "place2", "rate", "closed_end"], ["yr"])


def _stored_wrongly(spark: SparkSession, folder: str) -> DataFrame:
    """Current releases, but 1999 also keeps its first release and 2000 is one release behind."""
    cells = V.released_apps(spark, folder)
    good = (
        "CASE WHEN yr = 1999 THEN release IN ('first', 'final') WHEN yr = 2000 THEN release = 'middle' "
        "WHEN yr = 2001 THEN release = 'middle' ELSE release = 'final' END"
    )
    return cells.where(good)


def single_release(spark: SparkSession, folder: str) -> DataFrame:
    registered = R.most_mature(V.registry(spark, folder), "yr").select("yr", "release")
    return Q.single_release(_stored_wrongly(spark, folder), registered, "yr", "release")


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    return V.apps(spark, folder).groupBy("yr", "place1", "outcome").agg(F.count("*").alias("n"))


def _official(spark: SparkSession, folder: str) -> DataFrame:
    """Official counts with planted errors: off by one, and cells nobody else has."""
    cells = _cells(spark, folder)
    shifted = cells.where("NOT (yr = 1998 AND place1 = 'ASIA')").select(
        "yr", "place1", "outcome", F.expr("n + case when yr % 4 = 0 and outcome = 2 then 1 else 0 end").alias("n")
    )
    extra = cells.where("outcome = 1").select("yr", F.lit("NOWHERE").alias("place1"), "outcome", "n").groupBy(
        "yr", "place1", "outcome"
    ).agg(F.max("n").alias("n"))
    return shifted.unionByName(extra.where("yr = 1996"))


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    return Q.reconcile(_cells(spark, folder), _official(spark, folder), ["yr", "place1", "outcome"], "n")


def recon_cells(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder)


def sample_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """A stored sample against golden counts, of which one is one too many and one cell is unknown to the sample."""
    draw = F.expr("pmod(pmod(app_id, 1000003) * 2654435761, 1000000)")
    apps = V.apps(spark, folder)
    kept, path = ["yr", "outcome"], new_dir(spark, "golden-sample")
    sample_rows(apps, 0.1, draw).select(*kept, "app_id").write.partitionBy("yr").parquet(path)
    stored = spark.read.schema(sample_rows(apps, 0.1, draw).select("app_id", "outcome", "yr").schema).parquet(path)
    # Counted from all rows, without the stored sample.
    golden = apps.groupBy(*kept).agg(F.count_if(draw < 100_000).alias("n")).where("n > 0")
    shifted = golden.select(*kept, F.expr("n + case when yr = 1997 and outcome = 2 then 1 else 0 end").alias("n"))
    unknown = golden.where("yr = 1998 AND outcome = 1").select("yr", F.lit(9).cast(apps.schema["outcome"].dataType).alias("outcome"), "n")
    return Q.reconcile(stored.groupBy(*kept).agg(F.count("*").alias("n")), shifted.unionByName(unknown), kept, "n")


def recon_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return Q.reconciliation_verdict(_compared(spark, folder), ["yr"])


def recon_examples(spark: SparkSession, folder: str) -> DataFrame:
    """The first three differing cells of each year."""
    return Q.difference_examples(_compared(spark, folder), ["yr"], ["place1", "outcome"], 3)


def recon_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Entities whose row count differs from the published one."""
    ours = V.apps(spark, folder).groupBy("yr", "entity").agg(F.count("*").alias("n"))
    theirs = ours.where("entity <> 13").select(
        "yr", "entity", F.expr("n + case when (yr + entity) % 25 = 0 then 1 else 0 end").alias("n")
    )
    return Q.mismatches(Q.reconcile(ours, theirs, ["yr", "entity"], "n"))


def benchmark_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    """Denial rates against published ones; the published are rounded and partly shifted."""
    rate = F.avg((F.col("outcome") == 3).cast("double"))
    measured = V.apps(spark, folder).groupBy("ltype").agg(rate.alias("rate"))
    published = measured.select(
        "ltype",
        (F.round("rate", 3) + F.when(F.col("ltype").isin("BUILDING", "MACHINERY"), 0.01).otherwise(0.0)).alias("rate"),
    ).unionByName(measured.groupBy().agg(F.lit("SPACE").alias("ltype"), F.max("rate").alias("rate")))
    return Q.within_tolerance(measured, published, ["ltype"], "rate", 0.005).withColumns(
        {c: F.round(c, 6) for c in ("measured", "published", "diff")}
    )


def _checks(spark: SparkSession, folder: str) -> DataFrame:
    """All checks of one run as (yr, check_name, passed, detail)."""
    apps = V.apps(spark, folder)
    verdict = Q.reconciliation_verdict(_compared(spark, folder), ["yr"])
    nulls = Q.null_audit(apps, ["entity", "outcome", "purpose"], ["yr"])
    broken = Q.domain_violations(apps, {"outcome": "outcome BETWEEN 1 AND 3"}, ["yr"])
    single = Q.single_release(
        _stored_wrongly(spark, folder),
        R.most_mature(V.registry(spark, folder), "yr").select("yr", "release"),
        "yr",
        "release",
    )
    n_null = F.col("null_entity") + F.col("null_outcome") + F.col("null_purpose")
    parts = [
        verdict.select("yr", F.lit("official").alias("check_name"), "passed",
                       F.concat_ws(" ", F.col("cells").cast("string"), F.lit("cells,"), F.col("differing").cast("string"), F.lit("differ")).alias("detail")),
        nulls.select("yr", F.lit("essential").alias("check_name"), (n_null == 0).alias("passed"),
                     F.concat_ws(" ", n_null.cast("string"), F.lit("nulls")).alias("detail")),
        broken.select("yr", F.lit("domains").alias("check_name"), (F.col("violations") == 0).alias("passed"),
                      F.concat_ws(" ", F.col("violations").cast("string"), F.lit("violations")).alias("detail")),
        single.select("yr", F.lit("single_release").alias("check_name"), "passed",
                      F.concat_ws(" ", F.lit("stored"), F.col("n_releases").cast("string")).alias("detail")),
    ]
    return reduce(DataFrame.unionByName, parts)


def check_log(spark: SparkSession, folder: str) -> DataFrame:
    """One run of all checks appended to the log and read back."""
    log = new_dir(spark, "check-log")
    run = _checks(spark, folder).withColumn("run_at", F.current_timestamp())
    append_log(run, log)
    stored = spark.read.schema(run.schema).parquet(log)
    return Q.last_run(stored).select("yr", "check_name", "passed", "detail")


def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The gate in four situations: approved, failed, data changed since, never checked."""
    checks = V.apps(spark, folder).groupBy("yr", "outcome").agg(
        F.count("*").alias("n"), F.max("app_id").alias("run_at")
    )
    runs = checks.select(F.col("yr").cast("bigint").alias("run_at"), (F.col("n") > 0).alias("passed"))
    changes = checks.select((F.col("yr") - 1).cast("bigint").alias("changed_at"))
    failing = runs.withColumn("passed", F.col("run_at") < F.lit(2001))
    later = checks.select((F.col("yr") + 1).cast("bigint").alias("changed_at"))
    situations = {
        "approved": Q.gate(runs, changes),
        "failed": Q.gate(failing, changes),
        "stale": Q.gate(runs, later),
        "never": Q.gate(runs.where("passed IS NULL"), changes),
    }
    parts = [df.withColumn("situation", F.lit(name)) for name, df in situations.items()]
    return reduce(DataFrame.unionByName, parts)


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Headline numbers: share of checks passed, rows, releases and years covered."""
    checks = _checks(spark, folder)
    share = checks.agg(F.round(F.avg(F.col("passed").cast("double")), 6)).scalar()
    loads = V.registry(spark, folder).agg(
        F.sum("n_rows").alias("n_rows"), F.count("*").alias("releases"), F.count_distinct("yr").alias("years")
    )
    return loads.select("*", share.alias("share_passed"), checks.agg(F.count("*")).scalar().alias("checks"))


QUERIES = {
    "domain_checks": domain_checks,
    "null_audit": null_audit,
    "single_release": single_release,
    "recon_cells": recon_cells,
    "sample_reconciliation": sample_reconciliation,
    "recon_verdict": recon_verdict,
    "recon_examples": recon_examples,
    "recon_entities": recon_entities,
    "benchmark_tolerance": benchmark_tolerance,
    "check_log": check_log,
    "quality_gate": quality_gate,
    "run_summary": run_summary,
}

_CELL = "c AS (SELECT yr, place1, outcome, count(*) AS n FROM apps GROUP BY 1, 2, 3)"
_RECON = (
    f"{_CELL}, o AS (SELECT yr, place1, outcome, n + CASE WHEN yr % 4 = 0 AND outcome = 2 THEN 1 ELSE 0 END AS n FROM c "
    "WHERE NOT (yr = 1998 AND place1 = 'ASIA') UNION ALL "
    "SELECT yr, 'NOWHERE', outcome, max(n) FROM c WHERE outcome = 1 AND yr = 1996 GROUP BY yr, outcome), "
    "k AS (SELECT coalesce(c.yr, o.yr) AS yr, coalesce(c.place1, o.place1) AS place1, coalesce(c.outcome, o.outcome) AS outcome, "
    "coalesce(c.n, 0) AS observed, coalesce(o.n, 0) AS official, coalesce(c.n, 0) - coalesce(o.n, 0) AS diff "
    "FROM c FULL JOIN o ON c.yr = o.yr AND c.place1 = o.place1 AND c.outcome = o.outcome)"
)
_VERDICT = (
    "v AS (SELECT yr, count(*) AS cells, cast(sum(official) AS bigint) AS official_total, count(*) FILTER (diff <> 0) AS differing, "
    "count(*) FILTER (diff <> 0) = 0 AS passed FROM k GROUP BY yr)"
)
_SINGLE = (
    "st AS (SELECT yr, release FROM released WHERE CASE WHEN yr = 1999 THEN release IN ('first', 'final') "
    "WHEN yr IN (2000, 2001) THEN release = 'middle' ELSE release = 'final' END), "
    "si AS (SELECT yr, n_releases, stored, registered, n_releases = 1 AND stored = registered AS passed FROM "
    "(SELECT yr, count(DISTINCT release) AS n_releases, max(release) AS stored FROM st GROUP BY yr) LEFT JOIN "
    "(SELECT yr, arg_max(release, maturity) AS registered FROM registry GROUP BY yr) USING (yr))"
)
_CHECKS = (
    f"{_RECON}, {_VERDICT}, {_SINGLE}, ck AS ("
    "SELECT yr, 'official' AS check_name, passed, concat(cells, ' cells, ', differing, ' differ') AS detail FROM v UNION ALL "
    "SELECT yr, 'essential', count(*) FILTER (entity IS NULL OR outcome IS NULL OR purpose IS NULL) = 0, "
    "concat(count(*) FILTER (entity IS NULL) + count(*) FILTER (outcome IS NULL) + count(*) FILTER (purpose IS NULL), ' nulls') "
    "FROM apps GROUP BY yr UNION ALL "
    "SELECT yr, 'domains', count(*) FILTER (outcome NOT BETWEEN 1 AND 3) = 0, "
    "concat(count(*) FILTER (outcome NOT BETWEEN 1 AND 3), ' violations') FROM apps GROUP BY yr UNION ALL "
    "SELECT yr, 'single_release', passed, concat('stored ', n_releases) FROM si)"
)

ORACLE = {
    "domain_checks": " UNION ALL ".join(
        f"SELECT yr, count(*) AS n_rows, '{name}' AS rule, count(*) FILTER (({test}) IS NOT TRUE) AS violations FROM apps GROUP BY yr"
        for name, test in RULES.items()
    ),
    "null_audit": "SELECT yr, "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in ("entity", "outcome", "place2", "rate", "closed_end")
    )
    + " FROM apps GROUP BY yr",
    "single_release": f"WITH {_SINGLE} SELECT * FROM si",
    "recon_cells": f"WITH {_RECON} SELECT * FROM k",
    "sample_reconciliation": "WITH s AS (SELECT yr, outcome, count(*) AS n FROM apps "
    "WHERE (app_id % 1000003) * 2654435761 % 1000000 < 100000 GROUP BY yr, outcome) "
    "SELECT yr, outcome, n AS observed, n + CASE WHEN yr = 1997 AND outcome = 2 THEN 1 ELSE 0 END AS official, "
    "CASE WHEN yr = 1997 AND outcome = 2 THEN -1 ELSE 0 END::bigint AS diff FROM s UNION ALL "
    "SELECT yr, 9, 0, n, -n FROM s WHERE yr = 1998 AND outcome = 1",
    "recon_verdict": f"WITH {_RECON}, {_VERDICT} SELECT * FROM v",
    "recon_examples": f"WITH {_RECON}, f AS (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY place1, outcome) AS i "
    "FROM k WHERE diff <> 0) SELECT yr, string_agg(concat(place1, ' ', outcome, ' ', diff), '; ' ORDER BY i) AS examples "
    "FROM f WHERE i <= 3 GROUP BY yr",
    "recon_entities": "WITH a AS (SELECT yr, entity, count(*) AS n FROM apps GROUP BY 1, 2) "
    "SELECT yr, entity, n AS observed, CASE WHEN entity = 13 THEN 0 ELSE n + 1 END AS official, "
    "CASE WHEN entity = 13 THEN n ELSE -1 END AS diff FROM a WHERE entity = 13 OR (yr + entity) % 25 = 0",
    "benchmark_tolerance": "WITH m AS (SELECT ltype, avg(CASE WHEN outcome = 3 THEN 1.0::double ELSE 0 END) AS rate FROM apps GROUP BY 1), "
    "p AS (SELECT ltype, round(rate, 3) + CASE WHEN ltype IN ('BUILDING', 'MACHINERY') THEN 0.01::double ELSE 0 END AS rate FROM m "
    "UNION ALL SELECT 'SPACE', max(rate) FROM m) "
    "SELECT p.ltype, round(m.rate, 6) AS measured, round(p.rate, 6) AS published, round(m.rate - p.rate, 6) AS diff, "
    "coalesce(abs(m.rate - p.rate) <= 0.005, false) AS passed FROM p LEFT JOIN m USING (ltype)",
    "check_log": f"WITH {_CHECKS} SELECT * FROM ck",
    "quality_gate": "WITH c AS (SELECT cast(max(yr) AS bigint) AS last, count(DISTINCT (yr, outcome)) AS n, "
    "count(DISTINCT CASE WHEN yr >= 2001 THEN (yr, outcome) END) AS bad FROM apps), "
    "b AS (SELECT last, (SELECT count(DISTINCT outcome) FROM apps WHERE yr = last) AS k FROM c) "
    "SELECT last AS last_run, k AS checks, 0::bigint AS failures, last - 1 AS last_change, NULL::varchar AS refused_because, "
    "true AS approved, 'approved' AS situation FROM b UNION ALL "
    "SELECT last, k, k, last - 1, 'the last run has failures', false, 'failed' FROM b UNION ALL "
    "SELECT last, k, 0, last + 1, 'the data changed after the last run', false, 'stale' FROM b UNION ALL "
    "SELECT NULL, 0, 0, last - 1, 'no checks have run', false, 'never' FROM b",
    "run_summary": f"WITH {_CHECKS} SELECT (SELECT round(avg(cast(passed AS int)), 6) FROM ck) AS share_passed, "
    "(SELECT count(*) FROM ck) AS checks, (SELECT cast(sum(n_rows) AS bigint) FROM registry) AS n_rows, "
    "(SELECT count(*) FROM registry) AS releases, (SELECT count(DISTINCT yr) FROM registry) AS years",
}
