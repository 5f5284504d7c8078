"""Stateless streams: requests to predictions to telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame

from addrwatch.operators import requests as checks
from addrwatch.operators.additive import AdditiveModel
from addrwatch.operators.stats import Stats, collect_stats
from addrwatch.plans import serving


def score_stream(requests: DataFrame, stats: Stats, model: AdditiveModel) -> DataFrame:
    """Prediction records of a request stream.

    The statistics, a handful of numbers, are fixed when the stream starts.
    """
    fixed = collect_stats(stats) if isinstance(stats, DataFrame) else stats
    return serving.score(requests, fixed, model)


def rejected_stream(requests: DataFrame) -> DataFrame:
    """Requests with missing fields, and which ones."""
    return checks.rejected_requests(requests)


def telemetry_stream(predictions: DataFrame) -> DataFrame:
    return serving.telemetry(predictions)
