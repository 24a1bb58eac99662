"""Queries over the given tables, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = make
        if sql is not None:
            SQL[name] = sql
        return make

    return register


def load() -> None:
    from tablelens.queries import aggregation, filters, paging, ranking, streams, text, vectors, writes  # noqa: F401
