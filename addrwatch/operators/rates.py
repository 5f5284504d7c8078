"""Sliding event rates. The same code runs on a table and on a watermarked stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from addrwatch import config
from addrwatch.functions.labels import label_name, risk_level
from addrwatch.operators import requests as checks


def seconds(n: int) -> str:
    return f"{n} seconds"


def window_counts(
    df: DataFrame,
    window: int,
    slide: int = config.EVALUATION_SECONDS,
    by: Sequence[str] = (),
    ts: str = "ts",
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(window, *by, *counts)``: events in windows ``[start, end)`` of ``window``
    seconds, one every ``slide`` seconds.

    ``counts`` names conditions and defaults to ``n``, every event. A stream that
    watches rare events passes them as a condition here rather than filtering
    first, so that all its events move the watermark.

    Events are first counted in panes as wide as the slide, partly before any
    shuffle, and only those counts are added up to windows. Copying each event to
    ``window / slide`` windows is never needed.
    """
    if window % slide:
        raise ValueError("the window must be a whole number of slides")
    counts = counts or {"n": F.lit(True)}
    panes = df.groupBy(F.window(ts, seconds(slide)).alias("pane"), *by).agg(
        *[F.count_if(condition).alias(name) for name, condition in counts.items()]
    )
    return panes.groupBy(
        F.window(F.window_time("pane"), seconds(window), seconds(slide)).alias("window"), *by
    ).agg(*[F.sum(name).alias(name) for name in counts])


def as_rates(counted: DataFrame, window: int, by: Sequence[str] = ()) -> DataFrame:
    """``(window_start, window_end, *by, n, rate)`` of windows that saw an event."""
    return counted.filter(F.col("n") > 0).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *by, "n", (F.col("n") / F.lit(float(window))).alias("rate"),
    )


def sliding_rate(
    df: DataFrame,
    window: int,
    slide: int = config.EVALUATION_SECONDS,
    by: Sequence[str] = (),
    ts: str = "ts",
    condition: Column | None = None,
) -> DataFrame:
    """Events per second in each window, of those that meet the condition."""
    counts = None if condition is None else {"n": condition}
    return as_rates(window_counts(df, window, slide, by, ts, counts), window, by)


def prediction_rate(df: DataFrame, window: int, slide: int, ts: str = "ts") -> DataFrame:
    return sliding_rate(df.withColumn("label", label_name(F.col("prediction"))), window, slide, ["label"], ts)


def risk_rate(df: DataFrame, window: int, slide: int, score: str = "confidence", ts: str = "ts") -> DataFrame:
    leveled = df.withColumn("confidence_level", risk_level(F.col("prediction"), F.col(score)))
    return sliding_rate(leveled, window, slide, ["confidence_level"], ts)


def quality_counts(df: DataFrame, window: int, slide: int, ts: str = "ts") -> DataFrame:
    """``(window, quality_rule, n)``: one count per rule, turned into rows per window."""
    counted = window_counts(df, window, slide, (), ts, checks.broken_rules())
    rows = F.array(*[F.struct(F.lit(r).alias("quality_rule"), F.col(r).alias("n")) for r in checks.RULES])
    return counted.select("window", F.inline(rows)).filter(F.col("n") > 0)


def quality_rate(df: DataFrame, window: int, slide: int, ts: str = "ts") -> DataFrame:
    return as_rates(quality_counts(df, window, slide, ts), window, ["quality_rule"])


def prediction_split(df: DataFrame, window: int, slide: int, ts: str = "ts") -> DataFrame:
    """``(window_start, window_end, label, n, share)`` of the predictions in each window."""
    both = window_counts(df, window, slide, (), ts, {"_positive": F.col("prediction") == 1, "_n": F.lit(True)})
    parts = F.array(
        F.struct(F.lit(config.POSITIVE_LABEL).alias("label"), F.col("_positive").alias("n")),
        F.struct(F.lit(config.BENIGN_LABEL).alias("label"), (F.col("_n") - F.col("_positive")).alias("n")),
    )
    return both.select("window", "_n", F.inline(parts)).filter(F.col("n") > 0).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "label", "n", (F.col("n") / F.col("_n")).alias("share"),
    )


def is_http_error() -> Column:
    """The request was answered with anything but a 2xx status."""
    return ~F.col("status").rlike("^2..$")


def http_error_rate(
    log: DataFrame, window: int, slide: int, by: Sequence[str] = ("job", "instance"), ts: str = "ts"
) -> DataFrame:
    return sliding_rate(log.filter(is_http_error()), window, slide, by, ts)
