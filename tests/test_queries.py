"""Every registered query against its checking SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from civiclake.plans import catalogue
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalogue.QUERIES, catalogue.ORACLE


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLE[name]) == []


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["sk", "entered", "left", "same"] and df.count() > 0
