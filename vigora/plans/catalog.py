"""The catalog of queries over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query, and the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _register() -> None:
    from vigora.plans import graph_queries, instrument_queries, ledger_queries, rate_queries, record_queries, review_queries, temporal_queries, text_queries  # noqa: F401


_register()
