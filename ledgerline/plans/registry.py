"""Registry of named queries and of the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``views`` are the common table expressions its SQL needs."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = ("WITH " + ",\n".join(views) + "\n" if views else "") + sql.strip()
        return function

    return register
