"""The registered queries, each with the SQL it must agree with where there is one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def places(names: Sequence[str], digits: int = 6) -> list[Column]:
    """The columns rounded for comparison, with negative zero turned into zero."""
    return [(F.round(F.col(n), digits) + F.lit(0.0)).alias(n) for n in names]


def sql_places(names: Sequence[str], digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) + 0.0 AS {n}" for n in names)
