"""From a published file to exported aggregates, one resumable step at a time.

Every step reads stored tables and writes stored tables under one root folder, so each may run
in its own session. All applied releases of a year stay stored, whichever order they came in;
"current" is a choice of partitions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from civiclake.functions.numbers import canonical_number
from civiclake.operators import quality as Q
from civiclake.operators import releases as V
from civiclake.operators import revisions as R
from civiclake.operators import rules
from civiclake.operators.ranking import top_per_group
from civiclake.register import marts
from civiclake.register.rulebook import BOOK, CONSTRAINTS, ESSENTIAL
from civiclake.register.schema import COLUMNS, COMPARED, RELEASES, RESPELLED, check_source, maturity
from civiclake.session import tune
from civiclake.sources import commits
from civiclake.sources import landing as L
from civiclake.sources import publishing as P
from civiclake.sources.dimensions import lookup
from civiclake.sources.export import write_sections
from civiclake.sources.scratch import stage

LOAD_LOG = (
    "year int, release string, file string, content_hash string, lines bigint, rows bigint, "
    "corrupt bigint, changed_at timestamp"
)
REGISTRY = (
    "year int, release string, maturity int, frozen_at date, rows bigint, rejected bigint, "
    "with_alerts bigint, made_current boolean, applied_at timestamp"
)
CHECKS = "run_at timestamp, year int, check_name string, passed boolean, detail string"

_KEYS = [StructField("year", IntegerType()), StructField("release", StringType())]
_LINEAGE = [
    StructField("_file", StringType()),
    StructField("_file_size", LongType()),
    StructField("_content_hash", StringType()),
    StructField("_loaded_at", TimestampType()),
]


@dataclass(frozen=True)
class Lake:
    """A session and the root folder of the tables."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def log(self, name: str, schema: str) -> DataFrame:
        """A numbered log, its order in `commit`; empty before its first record."""
        return commits.read(self.spark, self.path(name), schema)

    def record(self, name: str, schema: str, values: tuple, at: str) -> None:
        """Append one record, stamped with the time of writing in column `at`."""
        row = self.spark.createDataFrame([(*values, None)], schema)
        commits.append(row.withColumn(at, F.current_timestamp()), self.path(name))

    def raw(self) -> DataFrame:
        schema = StructType([*L.text_schema(COLUMNS), *_LINEAGE, *_KEYS])
        return P.read_current(self.spark, self.path("raw"), schema)

    def typed(self) -> DataFrame:
        """Accepted rows of all stored releases."""
        return self._judged().where(F.col(rules.ACCEPTED)).drop(rules.ACCEPTED, rules.REASONS, rules.RAW_ROW)

    def rejected(self) -> DataFrame:
        reasons = F.split(rules.REASONS, r"\|").alias(rules.REASONS)
        return self._judged().where(~F.col(rules.ACCEPTED)).select("year", "release", *BOOK.keep, reasons, rules.RAW_ROW)

    def _judged(self) -> DataFrame:
        # The stored schema is fixed by the rulebook; only partition values would be guessed.
        if P.current_versions(self.spark, self.path("typed")).isEmpty():
            raw = self.spark.createDataFrame([], StructType([*L.text_schema(COLUMNS), *_LINEAGE, *_KEYS]))
            data = judged(raw, None).schema.fields
        else:
            stored = self.spark.read.parquet(self.path("typed")).schema
            data = [f for f in stored if f.name not in ("year", "release", "version", rules.ACCEPTED)]
            data.append(StructField(rules.ACCEPTED, BooleanType()))
        return P.read_current(self.spark, self.path("typed"), StructType([*data, *_KEYS]))

    def table(self, name: str) -> DataFrame:
        """A published table of results, with its stored types."""
        stored = self.spark.read.parquet(self.path(name)).drop("version")
        return P.read_current(self.spark, self.path(name), stored.schema)

    def registry(self) -> DataFrame:
        """All stored releases."""
        return V.latest_registration(self.log("registry", REGISTRY), "year", "commit").drop("commit")

    def chosen(self) -> DataFrame:
        """The release of each year that was made current last."""
        return V.switched_to(self.log("registry", REGISTRY), "year", "commit").drop("commit")

    def current(self) -> DataFrame:
        return V.read_releases(self.typed(), self.chosen(), "year")

    def as_of(self, day: date) -> DataFrame:
        return V.as_of(self.typed(), self.registry(), "year", day)


def judged(raw: DataFrame, frozen_at: date | None) -> DataFrame:
    """Typed rows, accepted or not, without the partition they lie in."""
    typed = rules.type_register(raw, BOOK, with_raw=True)
    accepted = (F.col(rules.REASONS) == "").alias(rules.ACCEPTED)
    keys = [c for c in typed.columns if c not in ("year", "release")]
    return typed.select(*keys, F.lit(frozen_at).cast("date").alias("frozen_at"), accepted)


def _at(df: DataFrame, year: int, release: str) -> DataFrame:
    return df.where((F.col("year") == year) & (F.col("release") == release))


def load_file(
    lake: Lake, csv: str, year: int, release: str, content_hash: str, force: bool = False
) -> str:
    """Land one file as raw partition (year, release): 'loaded', or 'unchanged' when the same
    content was loaded last. Refused when the header or the number of lines is wrong; what was
    stored before then stays."""
    check_source(year, release)
    log = _at(lake.log("load_log", LOAD_LOG), year, release)
    last = log.orderBy(F.desc("commit")).select("content_hash").first()
    if last and last[0] == content_hash and not force:
        return "unchanged"
    _, lines = L.require_headers(L.file_headers(lake.spark, csv, COLUMNS))
    tagged = L.with_lineage(L.read_text_csv(lake.spark, csv, COLUMNS), year, release, content_hash)
    partition = {"year": year, "release": release}
    corrupt = {"corrupt": F.col(L.CORRUPT).isNotNull()}
    found = P.publish(tagged.drop("_year", "_release"), lake.path("raw"), partition, lines, counts=corrupt)
    values = (year, release, csv.rsplit("/", 1)[-1], content_hash, lines, found["rows"], found["corrupt"])
    lake.record("load_log", LOAD_LOG, values, "changed_at")
    return "loaded"


def apply_release(lake: Lake, year: int, release: str, frozen_at: date, force: bool = False) -> str:
    """Type one raw partition and register it; the outcome says what became of it.

    'current': readers of the year now get this release. 'stored': a more mature one stays current,
    this one serves reads as of earlier days. 'unchanged': it was registered before. With `force`
    the partition is typed again and made current in any case. A broken constraint, or a row that
    gets lost, fails the job, and neither rows nor registry change.
    """
    check_source(year, release)
    tune(lake.spark)
    level = maturity(release)
    known = lake.registry().where(F.col("year") == year)
    if not force and not _at(known, year, release).isEmpty():
        return "unchanged"
    now = lake.chosen().where(F.col("year") == year).first()
    switch = force or now is None or now["maturity"] < level
    raw = _at(lake.raw(), year, release)
    loaded = _at(lake.log("load_log", LOAD_LOG), year, release).orderBy(F.desc("commit")).first()
    if loaded is None:
        raise ValueError(f"{year} {release} has not been loaded")
    accepted = F.col(rules.ACCEPTED)
    counts = {"valid": accepted, "with_alerts": accepted & (F.size(rules.ALERTS) > 0)}
    kept = {name: f"NOT {rules.ACCEPTED} OR ({test})" for name, test in CONSTRAINTS.items()}
    partition = {"year": year, "release": release}
    found = P.publish(
        judged(raw, frozen_at), lake.path("typed"), partition, loaded["rows"], inner=[rules.ACCEPTED], counts=counts, rules=kept
    )
    values = (year, release, level, frozen_at, found["valid"], found["rows"] - found["valid"], found["with_alerts"], switch)
    lake.record("registry", REGISTRY, values, "applied_at")
    return "current" if switch else "stored"


def run_scope(lake: Lake, sources: Iterable[tuple[str, int, str, str, date]]) -> list[tuple[int, str, str, str]]:
    """Load and apply sources (csv, year, release, content hash, frozen at) in the order of
    publication; returns (year, release, load outcome, apply outcome) of each."""
    done = []
    for csv, year, release, content, frozen_at in sorted(sources, key=lambda s: (s[4], s[1], maturity(s[2]))):
        loaded = load_file(lake, csv, year, release, content)
        done.append((year, release, loaded, apply_release(lake, year, release, frozen_at, force=False)))
    return done


def comparable_rows(raw: DataFrame) -> DataFrame:
    """Reported fields only, numbers in one spelling: what a lender said, however it was written."""
    return raw.select(
        *[(canonical_number(F.col(c)) if c in RESPELLED else F.col(c)).alias(c) for c in COMPARED]
    )


CARRIED = ("lei", "state_code", "action_taken", "loan_purpose")


class ProofFailed(RuntimeError):
    """The fingerprint result differs from the exact bag difference."""


def compare_releases(lake: Lake, year: int, earlier: str, later: str, proof_state: str | None, fields: bool = True) -> None:
    """Write what changed between two releases: rows, lenders, fields and a summary.

    On one state (none: on no rows) the result is proved against an exact bag difference before anything is published.
    """
    _compare(lake, year, [(earlier, later)], proof_state, [(earlier, later)] if fields else [])


def compare_all(lake: Lake, years: Iterable[int], proof_state: str | None) -> None:
    """Every pair of releases; fields only between the first and the last."""
    for year in years:
        _compare(lake, year, list(combinations(RELEASES, 2)), proof_state, [(RELEASES[0], RELEASES[-1])])


def _compare(lake: Lake, year: int, pairs: list[tuple[str, str]], proof_state: str | None, with_fields: list[tuple[str, str]]) -> None:
    """The pairs of one year from one tally: each release is read once, whatever the number of pairs."""
    for earlier, later in pairs:
        if maturity(earlier) >= maturity(later):
            raise ValueError(f"{earlier!r} does not precede {later!r}")
    rows = {r: comparable_rows(_at(lake.raw(), year, r)) for r in dict.fromkeys(r for pair in pairs for r in pair)}
    counted = stage(R.tally(R.tag_releases(rows, COMPARED), list(rows), COMPARED, carry=CARRIED), "tally")
    diffs = {pair: R.pair_of(counted, *pair) for pair in pairs}
    if proof_state is not None:
        for (earlier, later), diff in diffs.items():
            slices = [rows[r].where(F.col("state_code") == proof_state) for r in (earlier, later)]
            proof = R.multiset_proof(*slices, COMPARED, ["state_code"], diff.where(F.col("state_code") == proof_state))
            if proof.where(~F.col("agrees")).limit(1).count():
                raise ProofFailed(f"{year} {earlier} to {later} in {proof_state}")
    for (earlier, later), diff in diffs.items():
        results = {
            "rows": R.changed_only(diff),
            "entities": R.entity_rollup(diff, ["lei"]),
            "summary": R.pair_summary(diff),
        }
        if (earlier, later) in with_fields:
            changes = R.weighted_changes(rows[earlier], rows[later], COMPARED, diff=diff)
            results["fields"] = R.attribute_fields(changes, COMPARED)
        partition = {"year": year, "from_release": earlier, "to_release": later}
        for name, df in results.items():
            P.publish(df, lake.path(f"revisions/{name}"), partition)


def run_checks(
    lake: Lake, official: DataFrame | None = None, lender_counts: DataFrame | None = None
) -> DataFrame:
    """Run all checks on the current table, append them to the log and return this run.

    official: (year, state_code, action_taken, n), the published counts; a year without them
    fails. lender_counts: (year, lei, n), checked for the years they cover.
    """
    table = lake.current()
    chosen = lake.chosen()
    periods = chosen.select("year")

    def finding(df: DataFrame, name: str, detail) -> DataFrame:
        return df.select("year", F.lit(name).alias("check_name"), "passed", detail.alias("detail"))

    def said(*parts):
        return F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    single = Q.single_release(table, chosen, "year", "release")
    keys = ["year", "release"]
    wanted = chosen.select(*keys)
    read = [V.read_releases(t, wanted, "year") for t in (lake.raw(), lake.typed(), lake.rejected())]
    # From the registry: a release of which nothing is stored has no counts, and fails.
    counts = Q.conservation(*read, keys)
    kept = wanted.join(counts, keys, "left").fillna({c: 0 for c in ("n_raw", "n_valid", "n_rejected")})
    kept = kept.withColumns(
        {"conserved": F.coalesce("conserved", F.lit(False)), "no_rejects": F.coalesce("no_rejects", F.lit(False))}
    )
    broken = Q.domain_violations(table, CONSTRAINTS, ["year"])
    nulls = Q.null_audit(table, ESSENTIAL, ["year"])
    n_null = reduce(lambda a, b: a + b, [F.col(f"null_{c}") for c in ESSENTIAL])
    n_broken = broken.groupBy("year").agg(F.sum("violations").alias("n"))
    parts = [
        finding(single, "single release", said("stored", F.col("stored"))),
        finding(
            kept.withColumn("passed", F.col("conserved")),
            "conservation",
            said(F.col("n_raw"), "raw,", F.col("n_valid"), "valid,", F.col("n_rejected"), "rejected"),
        ),
        finding(kept.withColumn("passed", F.col("no_rejects")), "no rejects", said(F.col("n_rejected"), "rejected")),
        finding(n_broken.withColumn("passed", F.col("n") == 0), "constraints", said(F.col("n"), "violations")),
        finding(nulls.withColumn("passed", n_null == 0), "essential columns", said(n_null, "nulls")),
        finding(*_official_verdict(table, periods, official, said)),
    ]
    if lender_counts is not None:
        covered = lender_counts.select("year").distinct()
        ours = table.join(covered, "year", "left_semi").groupBy("year", "lei").agg(F.count("*").alias("n"))
        compared = Q.reconcile(ours, lender_counts, ["year", "lei"], "n")
        verdict = Q.reconciliation_verdict(compared, ["year"])
        parts.append(finding(verdict, "lenders", said(F.col("cells"), "lenders,", F.col("differing"), "differ")))
    run = reduce(DataFrame.unionByName, parts).withColumn("run_at", F.current_timestamp())
    staged = stage(run.select("run_at", "year", "check_name", "passed", "detail"), "checks")
    commits.append(staged, lake.path("checks"))
    return staged


def _official_verdict(table: DataFrame, periods: DataFrame, official: DataFrame | None, said):
    """Published state x outcome counts against ours; rows without a state are not published."""
    cells = ["year", "state_code", "action_taken"]
    ours = table.where(F.col("state_code").isNotNull()).groupBy(*cells).agg(F.count("*").alias("n"))
    ours = ours.withColumn("action_taken", F.col("action_taken").cast("string"))
    if official is None:
        official = ours.where(F.lit(False))
    theirs = official.select("year", "state_code", F.col("action_taken").cast("string"), "n")
    compared = Q.reconcile(ours, theirs.join(periods, "year", "left_semi"), cells, "n")
    examples = Q.difference_examples(compared, ["year"], cells[1:])
    verdict = Q.reconciliation_verdict(compared, ["year"]).join(examples, "year", "left")
    published = verdict.withColumn("passed", F.col("passed") & (F.col("official_total") > 0))
    return published, "official counts", said(F.col("cells"), "cells,", F.col("differing"), "differ", F.col("examples"))


def approve(lake: Lake) -> None:
    """Raise unless the last run of checks is clean and newer than the data."""
    changes = lake.log("registry", REGISTRY)
    Q.require_approval(lake.log("checks", CHECKS), changes, "run_at", "applied_at")


def build_marts(lake: Lake) -> None:
    """Write all marts from the current table, and the impact of each release."""
    approve(lake)
    table = lake.current()
    for name, mart in marts.MARTS.items():
        P.overwrite_table(mart(table), lake.path(f"marts/{name}"))
    several = lake.registry().groupBy("year").agg(F.count("*").alias("k")).where("k > 1")
    stored = V.read_releases(lake.typed(), lake.registry().join(several, "year", "left_semi"), "year")
    P.overwrite_table(marts.release_impact(stored, lake.registry()), lake.path("marts/impact"))


def export(lake: Lake, target: str, metro_names: DataFrame, lender_names: DataFrame, top: int = 12) -> None:
    """Published aggregates as JSON sections. metro_names: (place, name); lender_names: (lei, name).

    A metro without a name is left out; a lender without one is shown by its identifier.
    """
    approve(lake)

    def mart(name: str) -> DataFrame:
        return lake.spark.read.parquet(lake.path(f"marts/{name}"))

    prices = mart("price_income")
    entities = lake.table("revisions/entities")
    ends = entities.where((F.col("from_release") == RELEASES[0]) & (F.col("to_release") == RELEASES[-1]))
    moved = ends.withColumn("moved", F.col("entered") + F.col("left"))
    ranked = top_per_group(moved, ["year"], [F.desc("moved"), F.asc("lei")], top)
    checks = lake.log("checks", CHECKS)
    about = lake.spark.range(1).select(
        F.current_timestamp().alias("generated_at"), F.lit("public loan-application register").alias("source")
    )
    sections = {
        "about": about,
        "loads": lake.log("load_log", LOAD_LOG).drop("commit").orderBy("year", "release"),
        "releases": lake.registry().orderBy("frozen_at", "year", "maturity"),
        "checks": Q.last_run(checks).orderBy("year", "check_name"),
        "price_income_national": prices.where(F.col("grain") == "national").orderBy("year"),
        "price_income_state": prices.where(F.col("grain") == "state").orderBy("year", "place"),
        "price_income_metro": lookup(
            prices.where(F.col("grain") == "metro"), metro_names, ["place"], "name"
        ).orderBy("year", "place"),
        "market": mart("market").where(F.col("grain") != "metro").orderBy("year", "grain", "place", "purpose"),
        "denials": mart("denials").where(F.col("grain") != "metro").orderBy("year", "grain", "place", "purpose"),
        "denial_reasons": mart("denial_reasons").orderBy("year", "purpose", "reason"),
        "disparity": mart("disparity").where(F.col("publishable")).orderBy("year", "dimension", "grp"),
        "impact": mart("impact").orderBy("year", "frozen_at"),
        "revision_summary": lake.table("revisions/summary"),
        "revision_fields": lake.table("revisions/fields").orderBy(
            "year", "from_release", F.desc("pairs"), "field"
        ),
        "revision_lenders": moved.groupBy("year").agg(
            F.count("*").alias("lenders"),
            F.count_if(F.col("moved") > 0).alias("lenders_changed"),
            F.sum("before").alias("before"),
            F.sum("after").alias("after"),
        ),
        "top_lenders": lookup(ranked, lender_names, ["lei"], "name", F.col("lei")).orderBy("year", "rank"),
    }
    write_sections(sections, target)
