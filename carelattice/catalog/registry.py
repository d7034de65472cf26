"""Registered queries and their SQL equivalents on the star tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelattice.catalog.star_sql import PRELUDE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, extra: str = ""):
    """Register a query; ``sql`` reads the common table expressions of the star tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = PRELUDE + extra + "\n" + sql
        return fn

    return register
