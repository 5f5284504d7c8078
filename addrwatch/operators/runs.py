"""Choosing among training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from addrwatch import config


def finished_runs(runs: DataFrame, pattern: str = config.RUN_NAME_PATTERN) -> DataFrame:
    return runs.filter((F.col("status") == "FINISHED") & F.col("run_name").like(pattern))


def best_run(runs: DataFrame, pattern: str = config.RUN_NAME_PATTERN) -> DataFrame:
    """The finished run with the fewest false negatives; newest, then lowest id, on a tie."""
    order = [F.col("metrics")["fn"].asc_nulls_last(), F.col("start_ts").desc(), F.col("run_id")]
    return finished_runs(runs, pattern).orderBy(*order).limit(1)
