"""Codes to labels, numbers to bands, attributes to classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_match(cases: Sequence[tuple[Column, str]]) -> Column:
    """CASE WHEN over the cases in order; NULL when none holds."""
    head, *tail = cases
    start = F.when(head[0], F.lit(head[1]))
    return reduce(lambda expr, case: expr.when(case[0], F.lit(case[1])), tail, start)


def code_label(code: Column, labels: Mapping[object, str]) -> Column:
    """Label of a code; unknown and NULL codes give NULL."""
    return _first_match([(code == F.lit(key), label) for key, label in labels.items()])


def numeric_band(value: Column, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bands: label i for value < limits[i], the last label above; NULL stays NULL."""
    if len(labels) != len(limits) + 1:
        raise ValueError("one label more than limits is needed")
    cases = [(value < F.lit(limit), label) for limit, label in zip(limits, labels)]
    return _first_match(cases + [(value.isNotNull(), labels[-1])])


def mixed_band(
    text: Column, published: Mapping[str, str], exact: Sequence[tuple[int, int, str]]
) -> Column:
    """Ordered band of a field that holds band texts and, for a middle range, exact integers.

    `published` maps the band texts, `exact` gives (first, last, band) for the integers.
    Anything else is NULL, also an integer outside the exact ranges.
    """
    number = text.try_cast("int")
    cases = [(text == F.lit(key), band) for key, band in published.items()]
    cases += [(number.between(first, last), band) for first, last, band in exact]
    return _first_match(cases)


def priority_class(cases: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """First class whose condition holds; a NULL condition does not hold."""
    return F.coalesce(_first_match(cases), F.lit(otherwise))
