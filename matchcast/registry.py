"""Where queries and their SQL are kept by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with the same in SQL where SQL can express it."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def six(x) -> Column:
    """Doubles that two engines add up in different orders."""
    return F.round(x, 6)
