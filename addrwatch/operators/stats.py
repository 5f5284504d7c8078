"""Column statistics and class counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from addrwatch import config
from addrwatch.functions.numeric import safe_std

Stats = DataFrame | Mapping[str, tuple[float | None, float | None]]


def fit_stats(df: DataFrame, cols: Sequence[str] = config.Z_SCORE_COLS) -> DataFrame:
    """``(col, mean, std)`` of each column, from one aggregation over the data."""
    wide = df.agg(
        *[F.struct(F.mean(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in cols]
    )
    return wide.unpivot([], list(cols), "col", "stat").select("col", "stat.mean", "stat.std")


def collect_stats(stats: DataFrame) -> dict[str, tuple[float | None, float | None]]:
    """The statistics as plain numbers: one row per scaled column, five by default."""
    return {r["col"]: (r["mean"], r["std"]) for r in stats.collect()}


def attach_stats(df: DataFrame, stats: Stats, cols: Sequence[str], name: str = "_stats") -> DataFrame:
    """Give each row the struct ``name`` with ``(mean, std)`` of the columns.

    A lazy ``stats`` becomes one scalar subquery, run once and handed to the tasks
    as a constant: no join, no shuffle of the data. Collected ones become literals.
    """
    if isinstance(stats, DataFrame):
        one_row = stats.agg(
            *[F.max(F.when(F.col("col") == c, F.struct("mean", "std"))).alias(c) for c in cols]
        )
        value = one_row.select(F.struct(*cols).alias(name)).scalar()
    else:
        value = F.struct(*[
            F.struct(*[
                F.lit(number).cast("double").alias(part)
                for part, number in zip(("mean", "std"), stats.get(c, (None, None)))
            ]).alias(c)
            for c in cols
        ])
    return df.withColumn(name, value)


def apply_stats(
    df: DataFrame, stats: Stats, cols: Sequence[str] = config.Z_SCORE_COLS, eps: float = config.EPSILON
) -> DataFrame:
    """Z-score the columns in place; columns or statistics that are absent are left alone."""
    cols = [c for c in cols if c in df.columns and (isinstance(stats, DataFrame) or c in stats)]
    if not cols:
        return df

    def scaled(name: str) -> Column:
        fitted = F.col("_stats")[name]
        return (F.col(name) - fitted["mean"]) / safe_std(fitted["std"], eps)

    return attach_stats(df, stats, cols).withColumns({c: scaled(c) for c in cols}).drop("_stats")


def class_counts(df: DataFrame, target: str = config.TARGET) -> DataFrame:
    """``(positives, negatives)`` from one aggregation."""
    return df.agg(
        F.count_if(F.col(target) == 1).alias("positives"),
        F.count_if(F.col(target) == 0).alias("negatives"),
    )


def training_baseline(df: DataFrame, target: str = config.TARGET, run_id: str | None = None) -> DataFrame:
    """Training rows of each class, both present even when empty."""
    counted = class_counts(df, target).unpivot([], ["positives", "negatives"], "side", "n")
    return counted.select(
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(target).alias("target"),
        (F.col("side") == "positives").alias("value"),
        "n",
    )
