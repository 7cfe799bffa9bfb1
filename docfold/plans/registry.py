"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docfold.plans import (
    log_queries,
    log_sql,
    sink_queries,
    sink_sql,
    table_queries,
    table_sql,
)
from docfold.session import prepare

_QUERY_MODULES = (log_queries, table_queries, sink_queries)
_SQL_MODULES = (log_sql, table_sql, sink_sql)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for module in _QUERY_MODULES:
        for name, query in module.QUERIES.items():
            found[name] = _in_utc(query)
    return found


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _SQL_MODULES for name, sql in module.SQL.items()}


def _in_utc(query: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run
