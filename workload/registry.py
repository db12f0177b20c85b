"""Where the workload modules put their queries and reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
REFERENCE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, if SQL can express it, its reference."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = function
        if sql is not None:
            REFERENCE_SQL[name] = sql
        return function

    return add


def sql_list(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"
