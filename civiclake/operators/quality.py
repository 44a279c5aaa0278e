"""Blocking data-quality checks: everything is a DataFrame of findings, nothing is collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.operators.ranking import top_per_group


def _counted(inputs: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows per key of several tables as columns; each table is reduced before they meet."""
    parts = [
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*keys, *[(F.col("_n") if other == name else F.lit(0).cast("long")).alias(other) for other in inputs])
        for name, df in inputs.items()
    ]
    union = reduce(DataFrame.unionByName, parts)
    return union.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in inputs])


def conservation(
    raw: DataFrame, valid: DataFrame, rejected: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Per key: raw rows = valid + rejected, and whether there were no rejects at all."""
    counts = _counted({"n_raw": raw, "n_valid": valid, "n_rejected": rejected}, keys)
    return counts.withColumns(
        {
            "conserved": F.col("n_raw") == F.col("n_valid") + F.col("n_rejected"),
            "no_rejects": F.col("n_rejected") == 0,
        }
    )


def domain_violations(
    df: DataFrame, rules: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Rows breaking each rule (name -> SQL condition), in one pass. NULL counts as broken.

    Write `x IS NULL OR ...` where NULL is allowed.
    """
    broken = [F.count_if(~F.coalesce(F.expr(test), F.lit(False))).alias(name) for name, test in rules.items()]
    totals = df.groupBy(*by).agg(F.count("*").alias("n_rows"), *broken)
    pairs = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    )
    return totals.select(*by, "n_rows", F.inline(pairs))


def guarded(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """The same rows; the job that writes them fails on the first row breaking a rule.

    The check is a filter, so no action can prune it away as it could an unused column.
    """
    failing = F.concat_ws(
        ", ", *[F.when(~F.coalesce(F.expr(test), F.lit(False)), F.lit(name)) for name, test in rules.items()]
    )
    passed = F.when(F.col("_failing") == "", F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("check failed: "), F.col("_failing"))).cast("boolean")
    )
    return df.select("*", failing.alias("_failing")).where(passed).drop("_failing")


def null_audit(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """NULLs in the essential columns per period."""
    return df.groupBy(*by).agg(*[F.count_if(F.isnull(F.col(c))).alias(f"null_{c}") for c in columns])


def single_release(stored: DataFrame, registered: DataFrame, period: str, release: str) -> DataFrame:
    """Per period, stored or registered: exactly one release is stored and it is the registered one.

    A registered period of which nothing is stored fails."""
    found = stored.groupBy(period).agg(
        F.count_distinct(release).alias("n_releases"), F.max(release).alias("stored")
    )
    wanted = registered.select(period, F.col(release).alias("registered"))
    return (
        found.join(wanted, period, "full_outer")
        .withColumn("n_releases", F.coalesce("n_releases", F.lit(0).cast("long")))
        .withColumn("passed", (F.col("n_releases") == 1) & F.col("stored").eqNullSafe(F.col("registered")))
    )


def reconcile(
    observed: DataFrame, official: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """Observed against official cells; a cell missing on one side counts as zero.

    Both sides are added up in one aggregation over their union: no join, and a cell listed
    twice in the official source is summed.
    """
    zero = F.lit(0).cast("long")
    sides = observed.select(
        *keys, F.col(value).cast("long").alias("observed"), zero.alias("official")
    ).unionByName(
        official.select(*keys, zero.alias("observed"), F.col(value).cast("long").alias("official"))
    )
    return (
        sides.groupBy(*keys)
        .agg(F.sum("observed").alias("observed"), F.sum("official").alias("official"))
        .withColumn("diff", F.col("observed") - F.col("official"))
    )


def mismatches(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("diff") != 0)


def reconciliation_verdict(compared: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per period: cells, official total, differing cells and whether it passed."""
    return compared.groupBy(*by).agg(
        F.count("*").alias("cells"),
        F.sum("official").alias("official_total"),
        F.count_if(F.col("diff") != 0).alias("differing"),
        (F.count_if(F.col("diff") != 0) == 0).alias("passed"),
    )


def difference_examples(
    compared: DataFrame, by: Sequence[str], keys: Sequence[str], k: int = 10
) -> DataFrame:
    """Per period with differences, the first `k` differing cells as one text.

    Only k cells per period are ever gathered; `mismatches` has all of them.
    """
    first = top_per_group(mismatches(compared), by, [F.asc(c) for c in keys], k)
    cell = F.concat_ws(" ", *[F.col(c).cast("string") for c in (*keys, "diff")])
    listed = F.sort_array(F.collect_list(F.struct("rank", cell.alias("cell"))))
    return first.groupBy(*by).agg(F.array_join(listed["cell"], "; ").alias("examples"))


def within_tolerance(
    measured: DataFrame, published: DataFrame, keys: Sequence[str], value: str, tolerance: float
) -> DataFrame:
    """Published values beside measured ones; `passed` when they differ by at most `tolerance`.

    A published key that was not measured fails.
    """
    ours = measured.select(*keys, F.col(value).alias("measured"))
    theirs = published.select(*keys, F.col(value).alias("published"))
    return theirs.join(ours, list(keys), "left").withColumns(
        {
            "diff": F.col("measured") - F.col("published"),
            "passed": F.coalesce(
                F.abs(F.col("measured") - F.col("published")) <= tolerance, F.lit(False)
            ),
        }
    )


def last_run(checks: DataFrame, run: str = "run_at") -> DataFrame:
    """The findings of the latest run in the log."""
    return checks.where(F.col(run) == checks.agg(F.max(run)).scalar())


def gate(checks: DataFrame, changes: DataFrame, run: str = "run_at", changed: str = "changed_at") -> DataFrame:
    """One row: may the next stage run?

    Refused when no check ever ran, when the last run has a failure, or when the data changed
    after the last run. `checks` has (run, passed), `changes` the times of data changes.
    """
    in_last = last_run(checks, run)
    verdict = in_last.agg(
        F.max(run).alias("last_run"),
        F.count("*").alias("checks"),
        F.count_if(~F.coalesce(F.col("passed"), F.lit(False))).alias("failures"),
    ).withColumn("last_change", changes.agg(F.max(changed)).scalar())
    reason = (
        F.when(F.col("checks") == 0, "no checks have run")
        .when(F.col("failures") > 0, "the last run has failures")
        .when(F.col("last_change") > F.col("last_run"), "the data changed after the last run")
    )
    return verdict.select("*", reason.alias("refused_because"), reason.isNull().alias("approved"))


class NotApproved(RuntimeError):
    """The data may not be used downstream."""


def require_approval(checks: DataFrame, changes: DataFrame, run: str = "run_at", changed: str = "changed_at") -> None:
    """Raise unless the gate approves. Reads one row."""
    row = gate(checks, changes, run, changed).first()
    if row is None or not row["approved"]:
        raise NotApproved(row["refused_because"] if row else "no checks have run")
