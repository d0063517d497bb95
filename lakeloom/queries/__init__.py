"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = oracle
        return query

    return add


def load_all() -> None:
    from lakeloom.queries import (  # noqa: F401
        aggregates,
        dimensions,
        landing,
        layers,
        merges,
        metadata,
        nested,
        projections,
        responses,
        tasks,
    )
