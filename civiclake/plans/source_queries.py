"""Query catalogue: landing, publishing, logs, exports."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators import quality as Q
from civiclake.operators.grains import by_grain
from civiclake.operators.sampling import sample_rows
from civiclake.plans import views as V
from civiclake.plans.mart_queries import GRAINS
from civiclake.sources import dimensions as D
from civiclake.sources import export as X
from civiclake.sources import commits
from civiclake.sources import landing as L
from civiclake.sources import publishing as P
from civiclake.sources.scratch import new_dir

COLUMNS = V.RAW_TEXT


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """The raw view as CSV lines; some are cut after three fields, some have one too many, and
    blank lines stand between some."""
    raw = V.raw(spark, folder)
    whole = F.to_csv(F.struct(*COLUMNS))
    short = F.to_csv(F.struct(*COLUMNS[:3]))
    line = (
        F.when(F.col("rk") % 101 == 0, short)
        .when(F.col("rk") % 103 == 0, F.concat(whole, F.lit(",extra")))
        .otherwise(whole)
    )
    return raw.select("rk", line.alias("line"))


def csv_corrupt_capture(spark: SparkSession, folder: str) -> DataFrame:
    path = new_dir(spark, "csv")
    _lines(spark, folder).select("line").write.text(path)
    landed = new_dir(spark, "landed")
    L.read_text_csv(spark, path, COLUMNS, header=False).write.parquet(landed)
    stored = spark.read.schema(L.text_schema(COLUMNS)).parquet(landed)
    return stored.groupBy("yr_t").agg(
        F.count("*").alias("n_rows"),
        F.count(L.CORRUPT).alias("n_corrupt"),
        F.count("qty_t").alias("n_qty"),
        F.count("code_t").alias("n_code"),
        F.sum(F.length(L.CORRUPT)).alias("corrupt_chars"),
    )


def header_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Folders of several files: all headers right, all in another order, and one file wrong among
    right ones. A folder with a wrong header loads nothing."""
    raw = V.raw(spark, folder)
    reordered = [COLUMNS[1], COLUMNS[0], *COLUMNS[2:]]
    sources = {
        "expected": [raw.select(*COLUMNS)],
        "reordered": [raw.select(*reordered)],
        "one wrong file": [raw.select(*COLUMNS), raw.select(*COLUMNS[:-1], "pk")],
    }
    parts = []
    for name, contents in sources.items():
        path = new_dir(spark, "csv")
        for df in contents:
            df.write.mode("append").option("header", True).option("quoteAll", len(contents) > 1).csv(path)
        headers = L.file_headers(spark, path, COLUMNS)
        accepted = True
        try:
            L.require_headers(headers)
        except L.LoadRefused:
            accepted = False
        found = headers.agg(F.max("problem").alias("problem"), (F.count("*") > F.count("problem")).alias("some_right"), F.sum("lines").alias("n_lines"))
        loaded = L.read_text_csv(spark, path, COLUMNS) if accepted else raw.where(F.lit(False))
        rows = loaded.agg(F.count("*").alias("n_rows"))
        # How many files a folder gets depends on the session; whether some are right does not.
        parts.append(
            found.select(F.lit(name).alias("source"), "problem", "some_right", "n_lines", F.lit(rows.scalar()).alias("n_rows"))
        )
    return reduce(DataFrame.unionByName, parts)


def line_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """A clean source, and one with blank lines that the CSV parser drops and the counter sees."""
    lines = _lines(spark, folder)
    blank = lines.where("rk % 307 = 0").select(F.lit("").alias("line"))
    parts = []
    for name, df in (("clean", lines.select("line")), ("blank lines", lines.select("line").unionByName(blank))):
        path = new_dir(spark, "csv")
        df.write.text(path)
        counted = L.line_counts(spark, path, header=False)
        stored = L.read_text_csv(spark, path, COLUMNS, header=False).select(
            F.col("_metadata.file_path").alias("file")
        )
        per_file = L.line_reconciliation(counted, stored)
        parts.append(
            per_file.agg(
                F.sum("lines").alias("n_lines"),
                F.sum("rows").alias("n_rows"),
                F.bool_and("matches").alias("accepted"),
            ).withColumn("source", F.lit(name))
        )
    return parts[0].unionByName(parts[1])


def bronze_lineage(spark: SparkSession, folder: str) -> DataFrame:
    path = new_dir(spark, "csv")
    V.raw(spark, folder).select(*COLUMNS).write.option("header", True).csv(path)
    tagged = L.with_lineage(L.read_text_csv(spark, path, COLUMNS), 2021, "final", "9f2c", "2026-01-02 03:04:05")
    return tagged.groupBy(
        F.col("_year").alias("year"),
        F.col("_release").alias("release"),
        F.col("_content_hash").alias("content_hash"),
        F.date_format("_loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
    ).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("_file").endswith(".csv") & (F.col("_file_size") > 0)).alias("n_with_file"),
    )


def _stored_releases(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    root = new_dir(spark, "releases")
    rows = V.released_apps(spark, folder)
    P.publish_all(rows, root, "yr", "release")
    return root, rows


def _per_release(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    return P.read_current(spark, root, rows.schema).groupBy("yr", "release").agg(
        F.count("*").alias("n"), F.sum("amount").cast("double").alias("volume")
    )


def partition_replace(spark: SparkSession, folder: str) -> DataFrame:
    """One partition replaced by the rows of another release, one cleared, the rest untouched."""
    root, rows = _stored_releases(spark, folder)
    final = rows.where("yr = 1998 AND release = 'final'")
    P.publish(final, root, {"yr": 1998, "release": "first"})
    P.publish(rows.where("yr < 0"), root, {"yr": 1999, "release": "first"})
    return _per_release(spark, root, rows)


def staged_publish(spark: SparkSession, folder: str) -> DataFrame:
    """A publication with the right count and one whose count is wrong and changes nothing."""
    root, rows = _stored_releases(spark, folder)
    final = rows.where("yr = 1998 AND release = 'final'")
    P.publish(final, root, {"yr": 1998, "release": "first"}, final.count())
    try:
        P.publish(final, root, {"yr": 1999, "release": "first"}, final.count() + 1)
    except L.LoadRefused:
        return _per_release(spark, root, rows)
    raise AssertionError("a wrong count was published")


def retained_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A partition replaced twice and a refused write, then removal of what no reader can reach.

    One read of the first commit is open. What the table holds now, what that read still sees, and how
    many versions went.
    """
    root, rows = _stored_releases(spark, folder)
    opened = commits.last_commit(spark, f"{root}/{P.VERSIONS}")
    final = rows.where("yr = 1998 AND release = 'final'")
    P.publish(final, root, {"yr": 1998, "release": "first"})
    P.publish(final.where("outcome = 1"), root, {"yr": 1998, "release": "first"})
    try:
        P.publish(final, root, {"yr": 1999, "release": "first"}, 0)
    except L.LoadRefused:
        gone = P.retire(spark, root, keep=[opened], grace=timedelta(0))
    place = F.regexp_extract("place", "yr=([0-9]+)/release=(.*)", 1).cast(rows.schema["yr"].dataType), F.regexp_extract("place", "yr=([0-9]+)/release=(.*)", 2)
    removed = gone.groupBy(place[0].alias("yr"), place[1].alias("release")).agg(F.count("*").alias("n"), F.lit(None).cast("double").alias("volume"))
    seen = {"now": None, "at the first commit": opened}
    reads = [
        P.read_current(spark, root, rows.schema, at).groupBy("yr", "release").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("volume")).withColumn("what", F.lit(what))
        for what, at in seen.items()
    ]
    return reads[0].unionByName(reads[1]).unionByName(removed.withColumn("what", F.lit("removed versions")))


def load_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads per release appended to the log: what was loaded last, and how often."""
    log = new_dir(spark, "load-log")
    loads = V.registry(spark, folder).select(
        "yr", "release", "n_rows", F.lit(0).cast("bigint").alias("corrupt"), F.lit(1).alias("load")
    )
    P.append_log(loads, log)
    P.append_log(loads.withColumns({"load": F.lit(2), "n_rows": F.col("n_rows") + 5}).where("release <> 'first'"), log)
    stored = spark.read.schema(loads.schema).parquet(log)
    return stored.groupBy("yr", "release").agg(
        F.count("*").alias("loads"), F.max_by("n_rows", "load").alias("n_rows"), F.sum("corrupt").alias("corrupt")
    )


def write_guard(spark: SparkSession, folder: str) -> DataFrame:
    """A table under domain rules after a write that broke one of them: the old rows, all years."""
    root = new_dir(spark, "guarded")
    rules = {"outcome": "outcome BETWEEN 1 AND 3", "rate": "rate IS NULL OR rate BETWEEN 0 AND 13"}
    rows = V.apps(spark, folder)
    P.publish_all(Q.guarded(rows, rules), root, "yr")
    year = rows.where("yr = 1998")
    broken = year.withColumn("outcome", F.when(F.col("app_id") % 1000 == 7, 9).otherwise(F.col("outcome")).cast(rows.schema["outcome"].dataType))
    try:
        P.publish(Q.guarded(broken, rules), root, {"yr": 1998})
    except PySparkException as error:
        if "check failed" not in str(error):
            raise
    P.publish(Q.guarded(year.where("outcome = 1"), rules), root, {"yr": 1997})
    stored = P.read_current(spark, root, rows.schema)
    return stored.groupBy("yr").agg(F.count("*").alias("n"), F.count("rate").alias("n_rate"), F.sum("outcome").cast("bigint").alias("outcomes"))


def full_width_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Total text length over all columns: reads everything."""
    raw = V.raw(spark, folder)
    return raw.groupBy("yr").agg(F.sum(F.length(F.concat_ws("", *COLUMNS))).alias("chars"))


def export_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Aggregates written as JSON sections and read back."""
    root = new_dir(spark, "export")
    apps = V.apps(spark, folder)
    sections = {
        "by_place": by_grain(apps, ["yr"], GRAINS, [F.count("*").alias("n"), F.sum("amount").alias("volume")]),
        "by_segment": apps.groupBy("yr", F.col("ltype").alias("place")).agg(
            F.count("*").alias("n"), (F.sum("amount").cast("double") / F.count("*")).alias("volume")
        ),
        "releases": V.registry(spark, folder).select(
            "yr", F.col("release").alias("place"), F.col("n_rows").alias("n"), "frozen_at"
        ),
    }
    X.write_sections(sections, root)
    kind = "yr int, place string, n bigint, volume double, frozen_at string"
    parts = [
        spark.read.schema(kind).json(f"{root}/{name}").withColumn("section", F.lit(name)) for name in sections
    ]
    return reduce(DataFrame.unionByName, parts)


def nested_map_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Nested counts {type: {class: {n, total}}} of each event flattened and added up."""
    document = F.expr(
        "concat('{\"', event_type, '\": {\"', cast(event_id % 3 as string), '\": {\"n\": ', "
        "get_json_object(props, '$.k'), ', \"one\": 1}}}')"
    )
    events = V.table(spark, folder, "events").select(document.alias("doc"))
    flat = D.flatten_counts(events, "doc", ["event_type", "class"], "struct<n:bigint,one:bigint>")
    return flat.groupBy("event_type", "class").agg(F.sum("n").alias("k_total"), F.sum("one").alias("events"))


def sample_stratified(spark: SparkSession, folder: str) -> DataFrame:
    """The same tenth of every year, packed into one file."""
    draw = F.expr("pmod(pmod(app_id, 1000003) * 2654435761, 1000000)")
    sample = sample_rows(V.apps(spark, folder), 0.1, draw).select("yr", "app_id", "outcome")
    path = new_dir(spark, "sample")
    P.write_extract(sample, path, 1)
    return spark.read.schema(sample.schema).parquet(path)


QUERIES = {
    "csv_corrupt_capture": csv_corrupt_capture,
    "header_contract": header_contract,
    "line_reconciliation": line_reconciliation,
    "bronze_lineage": bronze_lineage,
    "partition_replace": partition_replace,
    "staged_publish": staged_publish,
    "retained_versions": retained_versions,
    "load_log": load_log,
    "write_guard": write_guard,
    "full_width_scan": full_width_scan,
    "export_sections": export_sections,
    "nested_map_flatten": nested_map_flatten,
    "sample_stratified": sample_stratified,
}

_QUOTED = {c: f"CASE WHEN {c} = '' THEN '\"\"' WHEN contains({c}, ',') THEN '\"' || {c} || '\"' ELSE {c} END" for c in COLUMNS}
_SHORT = " || ',' || ".join(_QUOTED[c] for c in COLUMNS[:3])
_WHOLE = " || ',' || ".join(_QUOTED[c] for c in COLUMNS)
_REPLACED = (
    "SELECT yr, release, count(*) AS n, cast(sum(amount) AS double) AS volume FROM ("
    "SELECT yr, release, amount FROM released WHERE NOT (yr = 1998 AND release = 'first'){and_clear} UNION ALL "
    "SELECT yr, 'first', amount FROM released WHERE yr = 1998 AND release = 'final') GROUP BY yr, release"
)

ORACLE = {
    "csv_corrupt_capture": "SELECT yr_t, count(*) AS n_rows, count(*) FILTER (rk % 101 = 0 OR rk % 103 = 0) AS n_corrupt, "
    "count(*) AS n_qty, count(*) FILTER (rk % 101 <> 0 AND code_t <> '') AS n_code, "
    f"cast(sum(CASE WHEN rk % 101 = 0 THEN length({_SHORT}) WHEN rk % 103 = 0 THEN length({_WHOLE}) + 6 END) AS bigint) AS corrupt_chars "
    "FROM raw GROUP BY yr_t",
    "header_contract": "SELECT 'expected' AS source, NULL::varchar AS problem, true AS some_right, count(*) AS n_lines, count(*) AS n_rows "
    "FROM raw UNION ALL SELECT 'reordered', 'the columns are in another order', false, count(*), 0 FROM raw UNION ALL "
    "SELECT 'one wrong file', 'unknown columns (pk), absent columns (co_t)', true, 2 * count(*), 0 FROM raw",
    "line_reconciliation": "SELECT 'clean' AS source, count(*) AS n_lines, count(*) AS n_rows, true AS accepted FROM raw UNION ALL "
    "SELECT 'blank lines', count(*) + count(*) FILTER (rk % 307 = 0), count(*), false FROM raw",
    "bronze_lineage": "SELECT 2021 AS year, 'final' AS release, '9f2c' AS content_hash, '2026-01-02 03:04:05' AS loaded_at, "
    "count(*) AS n_rows, count(*) AS n_with_file FROM raw",
    "partition_replace": _REPLACED.format(and_clear=" AND NOT (yr = 1999 AND release = 'first')"),
    "staged_publish": _REPLACED.format(and_clear=""),
    "retained_versions": "SELECT 'at the first commit' AS what, yr, release, count(*) AS n, cast(sum(amount) AS double) AS volume "
    "FROM released GROUP BY yr, release UNION ALL "
    "SELECT 'now', yr, release, count(*), cast(sum(amount) AS double) FROM ("
    "SELECT yr, release, amount FROM released WHERE NOT (yr = 1998 AND release = 'first') UNION ALL "
    "SELECT yr, 'first', amount FROM released WHERE yr = 1998 AND release = 'final' AND outcome = 1) GROUP BY yr, release UNION ALL "
    "SELECT 'removed versions', yr, 'first', 1, NULL FROM (SELECT DISTINCT yr FROM released WHERE yr IN (1998, 1999))",
    "load_log": "SELECT yr, release, CASE release WHEN 'first' THEN 1::bigint ELSE 2 END AS loads, "
    "n_rows + CASE release WHEN 'first' THEN 0 ELSE 5 END AS n_rows, 0::bigint AS corrupt FROM registry",
    "write_guard": "SELECT yr, count(*) AS n, count(rate) AS n_rate, cast(sum(outcome) AS bigint) AS outcomes FROM ("
    "SELECT yr, rate, outcome FROM apps WHERE yr <> 1997 UNION ALL SELECT 1997, rate, outcome FROM apps WHERE yr = 1998 AND outcome = 1) GROUP BY yr",
    "full_width_scan": "SELECT yr, cast(sum(length(concat(" + ", ".join(COLUMNS) + "))) AS bigint) AS chars FROM raw GROUP BY yr",
    "export_sections": "SELECT 'by_place' AS section, yr, place, n, round(volume, 6) AS volume, NULL::varchar AS frozen_at FROM ("
    "SELECT yr, 'ALL' AS place, count(*) AS n, cast(sum(amount) AS double) AS volume FROM apps GROUP BY yr UNION ALL "
    "SELECT yr, place1, count(*), cast(sum(amount) AS double) FROM apps GROUP BY yr, place1 UNION ALL "
    "SELECT yr, place2, count(*), cast(sum(amount) AS double) FROM apps WHERE place2 <> '99999' GROUP BY yr, place2) UNION ALL "
    "SELECT 'by_segment', yr, ltype, count(*), round(cast(sum(amount) AS double) / count(*), 6), NULL FROM apps GROUP BY yr, ltype UNION ALL "
    "SELECT 'releases', yr, release, n_rows, NULL, strftime(frozen_at, '%Y-%m-%d') FROM registry",
    "nested_map_flatten": "SELECT event_type, cast(event_id % 3 AS varchar) AS class, "
    "cast(sum(cast(props::json->>'$.k' AS bigint)) AS bigint) AS k_total, count(*) AS events FROM events GROUP BY 1, 2",
    "sample_stratified": "SELECT yr, app_id, outcome FROM apps WHERE (app_id % 1000003) * 2654435761 % 1000000 < 100000",
}
