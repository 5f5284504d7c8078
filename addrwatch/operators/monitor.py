"""Counts and distributions of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from addrwatch import config
from addrwatch.functions.labels import label_name, risk_level


def prediction_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(label_name(F.col("prediction")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def risk_counts(df: DataFrame, score: str = "confidence") -> DataFrame:
    level = risk_level(F.col("prediction"), F.col(score)).alias("confidence_level")
    return df.groupBy(level).agg(F.count(F.lit(1)).alias("n"))


def confidence_histogram(
    df: DataFrame, score: str = "confidence", bounds: Sequence[float] = config.CONFIDENCE_BUCKETS
) -> DataFrame:
    """``(le, n, total, observations)``: rows at or below each bound and, at ``+Inf``,
    all; next to the sum and number of all observations."""
    names = [str(b) for b in bounds] + ["+Inf"]
    wide = df.agg(
        *[F.count_if(F.col(score) <= b).alias(n) for b, n in zip(bounds, names)],
        F.count(score).alias("+Inf"),
        F.sum(score).alias("total"),
        F.count(score).alias("observations"),
    )
    return wide.unpivot(
        ["total", "observations"], [F.col(f"`{n}`") for n in names], "le", "n"
    ).select("le", "n", "total", "observations")


def latest_n(
    df: DataFrame, n: int = config.DRIFT_SAMPLE, ts: str = "ts", tie: str | None = "request_id"
) -> DataFrame:
    """The newest ``n`` rows: each task keeps its own top ``n``, then one merges them."""
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    return df.orderBy(*order).limit(n)


def drift_table(samples: DataFrame, metric: str = "psi") -> DataFrame:
    """Drift samples under their report names."""
    return samples.filter(F.col("metric") == metric).select(
        F.col("labels")["target"].alias("Feature"), F.col("value").alias("PSI Score")
    )
