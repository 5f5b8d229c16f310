"""Named queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql.strip()
        return function

    return register
