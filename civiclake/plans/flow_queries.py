"""Query catalogue: the register's flow over stored releases, from files to checks.

The orders become files of two years, each published twice; every step reads and writes the tables of
one lake below the shared folder.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.plans.register_queries import _REG, _narrow, _published
from civiclake.register import flow
from civiclake.register.schema import COLUMNS
from civiclake.sources.landing import LoadRefused
from civiclake.sources.scratch import new_dir, stage

YEARS = (2020, 2021)
FIRST, LAST = "snapshot", "three_year"
FROZEN = {FIRST: 2, LAST: 5}  # years after the activity year
#: Rows of both years that a task turns into published lines.
FILE_ROWS = 200_000


def _register(narrow: DataFrame) -> DataFrame:
    """All rows, dealt over two years, from what their columns are made of."""
    year = (F.lit(YEARS[0]) + F.col("year") % 2).cast("int")
    raw = _published(narrow).withColumn("year", year).withColumn("activity_year", F.col("year").cast("string"))
    return raw.select("year", *COLUMNS)


def _last(rows: DataFrame) -> DataFrame:
    """What the publisher changed: one lender's incomes, and another one left."""
    corrected = F.when((F.col("lei") == "LEI7") & (F.col("income") != "NA"), F.concat("income", F.lit("1"))).otherwise(F.col("income"))
    return rows.where("lei <> 'LEI5'").withColumn("income", corrected)


def _files(spark: SparkSession, folder: str, releases: tuple[str, ...]) -> list[tuple[str, int, str, str, date]]:
    """The published files as (path, year, release, content, frozen at)."""
    # Only the few columns all others are made of are staged. They are small, so their scan would make too few
    # tasks for the wide files: rows are dealt out by number.
    narrow, place = stage(_narrow(spark, folder), "flow-register"), new_dir(spark, "published")
    tasks = max(spark.sparkContext.defaultParallelism, narrow.count() // FILE_ROWS)
    rows = _register(narrow.repartition(tasks))
    found = []
    for year in YEARS:
        for release in releases:
            mine = (rows if release == FIRST else _last(rows)).where(F.col("year") == year)
            path = f"{place}/{year}_{release}.csv"
            mine.select(*COLUMNS).write.option("header", True).csv(path)
            found.append((path, year, release, f"{year} {release}", date(year + FROZEN[release], 6, 1)))
    return found


def _lake(spark: SparkSession) -> flow.Lake:
    return flow.Lake(spark, new_dir(spark, "lake"))


def flow_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """Files loaded once, again without a change, and once refused: what is stored and what was logged."""
    lake = _lake(spark)
    files = _files(spark, folder, (FIRST,))
    for path, year, release, content, _ in [*files, *files]:
        flow.load_file(lake, path, year, release, content)
    wrong = new_dir(spark, "wrong")
    lake.raw().select(*COLUMNS[1:], COLUMNS[0]).write.option("header", True).csv(wrong)
    try:
        flow.load_file(lake, wrong, YEARS[0], FIRST, "another content")
    except LoadRefused:
        loads = lake.log("load_log", flow.LOAD_LOG).groupBy("year", "release").agg(F.count("*").alias("loads"), F.sum("lines").alias("lines"))
        stored = lake.raw().groupBy("year", "release").agg(F.count("*").alias("n"), F.countDistinct("lei").alias("lenders"))
        return stored.join(loads, ["year", "release"])
    raise AssertionError("a file with a wrong header was loaded")


def _read(df: DataFrame, what: str) -> DataFrame:
    return df.groupBy("year", "release").agg(F.count("*").alias("n"), F.sum("income").alias("income")).withColumn("what", F.lit(what))


def forced_release(spark: SparkSession, folder: str) -> DataFrame:
    """All releases applied, then one year forced back to its first: what is current before and after, what was seen
    on a day between the two publications, and all stored rows."""
    lake = _lake(spark)
    flow.run_scope(lake, _files(spark, folder, (FIRST, LAST)))
    before = stage(_read(lake.current(), "current"), "flow-current")
    flow.apply_release(lake, YEARS[1], FIRST, date(YEARS[1] + FROZEN[FIRST], 6, 1), force=True)
    reads = [(lake.current(), "forced"), (lake.as_of(date(2023, 7, 1)), "as of July 2023"), (lake.typed(), "stored")]
    for df, what in reads:
        before = before.unionByName(_read(df, what))
    return before


def flow_revisions(spark: SparkSession, folder: str) -> DataFrame:
    """What changed for each lender between the releases of a year, proved on one state before it is published."""
    lake = _lake(spark)
    for path, year, release, content, _ in _files(spark, folder, (FIRST, LAST)):
        flow.load_file(lake, path, year, release, content)
    for year in YEARS:
        flow.compare_releases(lake, year, FIRST, LAST, "S1")
    pairs = lake.table("revisions/fields").groupBy("year").agg(F.sum(F.when(F.col("field") == "income", F.col("pairs"))).alias("incomes"))
    return lake.table("revisions/entities").join(pairs, "year").select("year", "lei", "before", "after", "entered", "left", "incomes")


def flow_checks(spark: SparkSession, folder: str) -> DataFrame:
    """All checks on the current table; one official count of one year is one too many."""
    lake = _lake(spark)
    files = _files(spark, folder, (LAST,))
    flow.run_scope(lake, files)
    cells = _last(_register(_narrow(spark, folder))).where("state_code <> 'NA' AND action_taken <> '9'").groupBy("year", "state_code", "action_taken").count()
    one_more = F.when((F.col("year") == YEARS[0]) & (F.col("state_code") == "S1") & (F.col("action_taken") == "1"), 1).otherwise(0)
    official = cells.select("year", "state_code", "action_taken", (F.col("count") + one_more).alias("n"))
    flow.run_checks(lake, official)
    return lake.log("checks", flow.CHECKS).select("year", "check_name", "passed")


QUERIES = {
    "flow_loaded": flow_loaded,
    "forced_release": forced_release,
    "flow_revisions": flow_revisions,
    "flow_checks": flow_checks,
}

_YEAR = "cast(2020 + cast(activity_year AS int) % 2 AS int) AS year"
_FLOW = (
    f"{_REG}, f1 AS (SELECT * EXCLUDE (activity_year), {_YEAR} FROM raw_reg), "
    "f2 AS (SELECT * REPLACE (CASE WHEN lei = 'LEI7' AND income <> 'NA' THEN income || '1' ELSE income END AS income) FROM f1 WHERE lei <> 'LEI5'), "
    "t1 AS (SELECT year, cast(nullif(income, 'NA') AS int) AS inc FROM f1 WHERE action_taken <> '9'), "
    "t2 AS (SELECT year, cast(nullif(income, 'NA') AS int) AS inc FROM f2 WHERE action_taken <> '9')"
)
_SUMS = "count(*) AS n, cast(sum(inc) AS bigint) AS income"

ORACLE = {
    "flow_loaded": f"WITH {_FLOW} SELECT year, 'snapshot' AS release, count(*) AS n, count(DISTINCT lei) AS lenders, "
    "1::bigint AS loads, count(*) AS lines FROM f1 GROUP BY year",
    "forced_release": f"WITH {_FLOW} SELECT 'current' AS what, year, 'three_year' AS release, {_SUMS} FROM t2 GROUP BY year UNION ALL "
    f"SELECT 'forced', year, 'three_year', {_SUMS} FROM t2 WHERE year = 2020 GROUP BY year UNION ALL "
    f"SELECT 'forced', year, 'snapshot', {_SUMS} FROM t1 WHERE year = 2021 GROUP BY year UNION ALL "
    f"SELECT 'as of July 2023', year, 'snapshot', {_SUMS} FROM t1 GROUP BY year UNION ALL "
    f"SELECT 'stored', year, 'snapshot', {_SUMS} FROM t1 GROUP BY year UNION ALL "
    f"SELECT 'stored', year, 'three_year', {_SUMS} FROM t2 GROUP BY year",
    "flow_revisions": f"WITH {_FLOW}, l AS (SELECT * FROM f1 EXCEPT ALL SELECT * FROM f2), e AS (SELECT * FROM f2 EXCEPT ALL SELECT * FROM f1), "
    "m AS (SELECT year, lei, 1 AS b, 0 AS a, 0 AS e, 0 AS l FROM f1 UNION ALL SELECT year, lei, 0, 1, 0, 0 FROM f2 UNION ALL "
    "SELECT year, lei, 0, 0, 1, 0 FROM e UNION ALL SELECT year, lei, 0, 0, 0, 1 FROM l), "
    "i AS (SELECT year, count(*) AS incomes FROM e GROUP BY year) "
    "SELECT m.year, lei, cast(sum(b) AS bigint) AS before, cast(sum(a) AS bigint) AS after, cast(sum(e) AS bigint) AS entered, "
    'cast(sum(l) AS bigint) AS "left", any_value(incomes) AS incomes FROM m JOIN i ON i.year = m.year GROUP BY m.year, lei',
    "flow_checks": f"WITH {_FLOW}, n AS (SELECT year, count(*) FILTER (action_taken = '9') AS rejected FROM f2 GROUP BY year) "
    "SELECT year, check_name, CASE check_name WHEN 'no rejects' THEN rejected = 0 WHEN 'official counts' THEN year <> 2020 ELSE true END AS passed "
    "FROM n, (VALUES ('single release'), ('conservation'), ('no rejects'), ('constraints'), ('essential columns'), ('official counts')) AS c(check_name)",
}
