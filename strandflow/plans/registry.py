"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Figures worked out by hand over inline reads: they read no table, so they are tests, not queries.
GOLDEN: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def golden(sql: str):
    """Registers a function that reads no table, with the rows that it gives."""

    def add(f):
        GOLDEN[f.__name__] = (f, sql)
        return f

    return add
