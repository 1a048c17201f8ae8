"""The registry behind ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name``; without ``sql`` it is checked by tests only."""

    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register
