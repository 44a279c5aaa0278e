"""All registered queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from civiclake.plans import (
    change_queries,
    flow_queries,
    layout_queries,
    mart_queries,
    quality_queries,
    register_queries,
    release_queries,
    rule_queries,
    source_queries,
)
from civiclake.plans.views import with_views
from civiclake.session import tune

_MODULES = (
    change_queries,
    rule_queries,
    mart_queries,
    release_queries,
    quality_queries,
    source_queries,
    layout_queries,
    register_queries,
    flow_queries,
)


def _tuned(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(tune(spark), folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
for _module in _MODULES:
    QUERIES.update({key: _tuned(query) for key, query in _module.QUERIES.items()})
    ORACLE.update({key: with_views(sql) for key, sql in _module.ORACLE.items()})
