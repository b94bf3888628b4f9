"""Where the query modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        ORACLES[name or fn.__name__] = sql
        return fn

    return register
