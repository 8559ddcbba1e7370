"""Name → query and name → SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str | Callable[[], str | None]] = {}


def query(
    name: str, sql: str | Callable[[], str | None] | None = None
) -> Callable[[Query], Query]:
    """Registers a query; ``sql`` may be made when asked for, and may then be None."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def oracles() -> dict[str, str]:
    made = {name: sql() if callable(sql) else sql for name, sql in ORACLES.items()}
    return {name: sql for name, sql in made.items() if sql is not None}
