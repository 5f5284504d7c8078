"""Queries over the given tables: one per operator, with comparison SQL."""

from addrwatch.catalog import (  # noqa: F401
    activity_queries,
    evaluation_queries,
    monitoring_queries,
    scoring_queries,
    stream_queries,
)
from addrwatch.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
