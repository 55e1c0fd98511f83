"""Registered queries: every query reads the driver tables under ``sf_dir`` and
returns a DataFrame; most carry a DuckDB oracle stating the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
# Operator ids each query exercises.
COVERS: dict[str, str] = {}


def register(name: str, oracle: str | None = None, covers: str = "") -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        COVERS[name] = covers
        return fn
    return wrap


def load_all() -> None:
    """Import the modules that register queries."""
    from slotwise.plans import batch_queries, ingest_queries, report_queries, stream_queries  # noqa: F401
