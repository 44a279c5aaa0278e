"""Cleaning, typing and validation of all-text rows, driven by tables of fields and rules.

Three projections, one after the other: clean, type, validate. Each value is computed once
and later stages only refer to finished columns, so the generated code stays small enough to
compile. No expression uses a lambda, which would drop out of whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separates reasons in one text; no label may contain it.
SEPARATOR = "|"
REASONS = "reject_reasons"
ALERTS = "alerts"
RAW_ROW = "raw_row"
ACCEPTED = "accepted"
_RAW = "__raw"


@dataclass(frozen=True)
class Field:
    """One column of the typed table.

    kind: "text", "code" (integer code), "yesno" (1 true, 2 false), "int",
    "whole" (integer that may be written '85.0') or "decimal(p,s)".
    domain: codes allowed; another code rejects the row.
    listed: documented texts; another text is an alert and becomes NULL.
    not_applicable: values that mean "does not apply" and become NULL at the end.
    markers: further texts that mean "no value" in this column only.
    """

    source: str
    target: str
    kind: str = "text"
    domain: tuple[int, ...] = ()
    listed: tuple[str, ...] = ()
    not_applicable: tuple[object, ...] = ()
    markers: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rulebook:
    """Everything that is specific to one register.

    markers: texts meaning "no value" in every column; flagged: those that set `flag`.
    keep: columns carried through; context: columns that only the rules look at;
    also_flagged: further columns searched for flagged markers.
    rejects and alerts: (label, SQL condition) over cleaned text (`<source>__text`), typed
    columns and passthrough columns. bands: target -> (source, function from the cleaned text
    to a band). derived: further result columns as SQL over typed columns.
    """

    fields: tuple[Field, ...]
    markers: tuple[str, ...]
    flagged: tuple[str, ...] = ()
    flag: str = "any_marker"
    keep: tuple[str, ...] = ()
    context: tuple[str, ...] = ()
    also_flagged: tuple[str, ...] = ()
    bands: Mapping[str, tuple[str, Callable[[Column], Column]]] = field(default_factory=dict)
    rejects: tuple[tuple[str, str], ...] = ()
    alerts: tuple[tuple[str, str], ...] = ()
    derived: Mapping[str, str] = field(default_factory=dict)


def text(source: str) -> Column:
    """The cleaned text of a source column."""
    return F.col(f"{source}__text")


def clean_column(name: str, markers: Sequence[str]) -> Column:
    value = F.col(name)
    return F.when(~value.isin(*markers), value)


def any_flag(marked: Mapping[str, Sequence[str]]) -> Column:
    """True when any column holds one of its marker texts; never NULL."""
    tests = [F.col(name).eqNullSafe(F.lit(m)) for name, texts in marked.items() for m in texts]
    return reduce(lambda a, b: a | b, tests)


def clean(df: DataFrame, book: Rulebook, with_raw: bool = False) -> DataFrame:
    """Markers become NULL, once per column; optionally the untouched row rides along."""
    columns = [
        clean_column(f.source, (*book.markers, *f.markers)).alias(f"{f.source}__text")
        for f in book.fields
    ]
    marked = {c: book.flagged for c in book.also_flagged}
    marked |= {f.source: (*book.flagged, *f.markers) for f in book.fields}
    extra = [F.col(c).alias(f"{c}{_RAW}") for c in df.columns] if with_raw else []
    return df.select(*book.keep, *book.context, *columns, any_flag(marked).alias(book.flag), *extra)


def typed(value: Column, kind: str) -> Column:
    """Readable text as its type; unreadable text is NULL."""
    if kind == "text":
        return value
    if kind == "yesno":
        return F.when(value == "1", F.lit(True)).when(value == "2", F.lit(False))
    if kind in ("code", "int"):
        return value.try_cast("int")
    if kind == "whole":
        number = value.try_cast("decimal(28,6)")
        return F.when(number == F.floor(number), number).try_cast("int")
    return value.try_cast(kind)


def apply_types(df: DataFrame, book: Rulebook) -> DataFrame:
    columns = [typed(text(f.source), f.kind).alias(f.target) for f in book.fields]
    bands = [build(text(source)).alias(name) for name, (source, build) in book.bands.items()]
    return df.select("*", *columns, *bands)


def reject_rules(book: Rulebook) -> list[tuple[str, Column]]:
    """The book's own rules followed by those that each field's kind implies."""
    rules = [(label, F.expr(test)) for label, test in book.rejects]
    for f in book.fields:
        given, value = text(f.source).isNotNull(), F.col(f.target)
        if f.kind == "code":
            outside = value.isNull() | ~value.isin(*f.domain) if f.domain else value.isNull()
            rules.append((f"{f.source} outside domain", given & outside))
        elif f.kind == "yesno":
            rules.append((f"{f.source} outside domain", given & value.isNull()))
        elif f.kind != "text":
            rules.append((f"{f.source} not numeric", given & value.isNull()))
    for name, (source, _) in book.bands.items():
        rules.append((f"{source} outside domain", text(source).isNotNull() & F.col(name).isNull()))
    return rules


def alert_rules(book: Rulebook) -> list[tuple[str, Column]]:
    listed = [
        (f"{f.source} undocumented", text(f.source).isNotNull() & ~text(f.source).isin(*f.listed))
        for f in book.fields
        if f.listed
    ]
    return [(label, F.expr(test)) for label, test in book.alerts] + listed


def joined_labels(rules: Sequence[tuple[str, Column]]) -> Column:
    """Labels of the rules that hold, joined; empty when none does."""
    return F.concat_ws(SEPARATOR, *[F.when(test, F.lit(label)) for label, test in rules])


def label_array(labels: Column) -> Column:
    """Joined labels as an array; the empty text gives the empty array."""
    return F.array_remove(F.split(labels, r"\|"), "")


def final_value(f: Field) -> Column:
    """Undocumented and not-applicable values become NULL, codes become small."""
    value = F.col(f.target)
    if f.listed:
        value = F.when(value.isin(*[v for v in f.listed if v not in f.not_applicable]), value)
    elif f.not_applicable:
        value = F.when(~value.isin(*f.not_applicable), value)
    return (value.cast("smallint") if f.kind == "code" else value).alias(f.target)


def validate(df: DataFrame, book: Rulebook) -> DataFrame:
    reasons = joined_labels(reject_rules(book))
    # The untouched row is put together for rejected rows only.
    raw = [F.col(c).alias(c.removesuffix(_RAW)) for c in df.columns if c.endswith(_RAW)]
    extra = [F.when(reasons != "", F.struct(*raw)).alias(RAW_ROW)] if raw else []
    return df.select(
        *book.keep,
        *[final_value(f) for f in book.fields],
        *book.bands,
        book.flag,
        *[F.expr(sql).alias(name) for name, sql in book.derived.items()],
        label_array(joined_labels(alert_rules(book))).alias(ALERTS),
        reasons.alias(REASONS),
        *extra,
    )


def type_register(df: DataFrame, book: Rulebook, with_raw: bool = False) -> DataFrame:
    """Raw text rows to typed rows with alerts and reject reasons (empty text = valid).

    Do not filter the result by its reasons: Spark would push the filter below the three
    stages and compute every value twice. Use `split_register`, which splits by writing.
    """
    cleaned = df.transform(clean, book, with_raw)
    return cleaned.transform(apply_types, book).transform(validate, book)


def split_register(
    df: DataFrame, book: Rulebook, root: str, partitions: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Type every row once, write valid and rejected rows side by side, return both scans.

    The table is partitioned by `partitions` and `accepted`, so each scan opens its own
    folders. Rejected rows have the passthrough columns, the reasons as an array and the
    untouched row.
    """
    typed_rows = type_register(df, book, with_raw=True)
    marked = typed_rows.withColumn(ACCEPTED, F.col(REASONS) == "")
    if partitions:  # otherwise every task would write every partition
        marked = marked.hint("rebalance", *(F.col(c) for c in (*partitions, ACCEPTED)))
    marked.write.mode("errorifexists").partitionBy(*partitions, ACCEPTED).parquet(root)
    stored = df.sparkSession.read.schema(marked.schema).parquet(root)
    valid = stored.where(F.col(ACCEPTED)).drop(ACCEPTED, REASONS, RAW_ROW)
    rejected = stored.where(~F.col(ACCEPTED)).select(
        *book.keep, F.split(REASONS, r"\|").alias(REASONS), RAW_ROW
    )
    return valid, rejected


def label_counts(
    typed_rows: DataFrame, rules: Sequence[tuple[str, Column]], by: Sequence[str]
) -> DataFrame:
    """Rows per rule that holds, as (by, label, n), without building label lists per row."""
    names = [f"_n{i}" for i in range(len(rules))]
    counts = typed_rows.groupBy(*by).agg(
        *[F.count_if(test).alias(name) for name, (_, test) in zip(names, rules)]
    )
    pairs = F.array(
        *[F.struct(F.lit(label).alias("label"), F.col(name).alias("n")) for name, (label, _) in zip(names, rules)]
    )
    return counts.select(*by, F.inline(pairs)).where(F.col("n") > 0)
