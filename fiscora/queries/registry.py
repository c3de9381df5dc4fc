"""Registered queries: name -> Spark job, and name -> expected result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``. Without ``sql`` only its rows can be checked."""

    def add(job: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = job
        if sql is not None:
            EXPECTED[name] = sql
        return job

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from fiscora.queries import audit, ingest, quality, scalars, silver_gold, stores  # noqa: F401
