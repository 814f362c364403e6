"""Registry of the queries over the test tables and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: QueryFunction
    sql: str | None
    operators: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def query(name: str, operators: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query with the operator ids it exercises and its SQL check."""

    def register(run: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql, tuple(operators.split()))
        return run

    return register
