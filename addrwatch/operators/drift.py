"""Population stability of the predicted classes against the training classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from addrwatch import config
from addrwatch.functions.dates import micros
from addrwatch.operators.monitor import latest_n
from addrwatch.operators.prefix import here, running_totals


def class_shares(df: DataFrame, flag: Column, eps: float = config.DRIFT_EPSILON) -> DataFrame:
    """``(value, share)`` of true and false, each with a small constant added."""
    wide = df.agg(
        (F.avg(flag.cast("double")) + eps).alias("true"),
        (F.avg((~flag).cast("double")) + eps).alias("false"),
    )
    return wide.unpivot([], ["true", "false"], "value", "share").select(
        (F.col("value") == "true").alias("value"), "share"
    )


def baseline_shares(baseline: DataFrame, eps: float = config.DRIFT_EPSILON) -> DataFrame:
    """``(value, share)`` of a stored baseline ``(value, n)``."""
    wide = baseline.agg(
        F.sum(F.when(F.col("value"), F.col("n")).otherwise(0)).alias("t"), F.sum("n").alias("all")
    ).select(
        (F.try_divide(F.col("t"), F.col("all")) + eps).alias("true"),
        (F.try_divide(F.col("all") - F.col("t"), F.col("all")) + eps).alias("false"),
    )
    return wide.unpivot([], ["true", "false"], "value", "share").select(
        (F.col("value") == "true").alias("value"), "share"
    )


def psi_term(base: Column, live: Column) -> Column:
    return (live - base) * F.log(live / base)


def psi(base: DataFrame, live: DataFrame) -> DataFrame:
    """One row ``psi``: both sides have one row per class value."""
    paired = base.select("value", F.col("share").alias("_base")).join(
        live.select("value", F.col("share").alias("_live")), "value"
    )
    return paired.agg(F.sum(psi_term(F.col("_base"), F.col("_live"))).alias("psi"))


def _shares_struct(baseline: DataFrame, eps: float) -> Column:
    shares = baseline_shares(baseline, eps)
    return shares.agg(F.struct(
        F.max(F.when(F.col("value"), F.col("share"))).alias("true"),
        F.max(F.when(~F.col("value"), F.col("share"))).alias("false"),
    ).alias("s")).scalar()


def drift_report(
    baseline: DataFrame,
    telemetry: DataFrame,
    n: int = config.DRIFT_SAMPLE,
    ts: str = "ts",
    tie: str | None = "request_id",
    flag: str = config.TARGET,
    eps: float = config.DRIFT_EPSILON,
) -> DataFrame:
    """One row on the newest ``n`` predictions: skipped when there are fewer, else
    the stability index, the four shares and the severity limits it passed."""
    counts = latest_n(telemetry, n, ts, tie).agg(
        F.count(F.lit(1)).alias("count"), F.count_if(F.col(flag)).alias("_true"),
    )
    enough = F.col("count") >= n
    base = F.col("_base")
    live_true = F.try_divide(F.col("_true"), F.col("count")) + eps
    live_false = F.try_divide(F.col("count") - F.col("_true"), F.col("count")) + eps
    row = counts.withColumn("_base", _shares_struct(baseline, eps)).select(
        F.when(enough, "success").otherwise("skipped").alias("status"),
        F.when(~enough, "insufficient_data").alias("reason"),
        "count",
        F.when(enough, base["true"]).alias("training_true"),
        F.when(enough, base["false"]).alias("training_false"),
        F.when(enough, live_true).alias("latest_true"),
        F.when(enough, live_false).alias("latest_false"),
    )
    value = psi_term(F.col("training_true"), F.col("latest_true")) + psi_term(
        F.col("training_false"), F.col("latest_false")
    )
    return row.withColumn("psi", value)


def drift_series(
    baseline: DataFrame,
    telemetry: DataFrame,
    n: int = config.DRIFT_SAMPLE,
    ts: str = "ts",
    tie: str = "request_id",
    flag: str = config.TARGET,
    eps: float = config.DRIFT_EPSILON,
    rows_per_range: int = config.RANGE_ROWS,
) -> DataFrame:
    """``(ts, tie, psi)``: the index on the latest ``n`` predictions as it stood after
    each one, from the n-th on.

    Running totals number the rows and count positives; the count ``n`` rows before is read inside the row's own
    range. Only for the first ``n`` rows of a range does it come from the last ``n`` rows of those before: a join of
    these few rows on their numbers. The rows themselves are shuffled once.
    """
    whole = here().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = running_totals(
        telemetry.select(ts, tie, flag), micros(F.col(ts)),
        {"_row": F.lit(1).cast("bigint"), "_positive": F.col(flag).cast("bigint")},
        tie=F.col(tie), rows_per_range=rows_per_range,
        extra={"_before": F.lag("_positive", n).over(here()), "_left": F.max("_row").over(whole) - F.col("_row")},
    )
    inside = numbered.filter(F.col("_before").isNotNull())
    tails = numbered.filter(F.col("_left") < n).select((F.col("_row") + n).alias("_row"), F.col("_positive").alias("_before"))
    heads = numbered.filter(F.col("_before").isNull() & (F.col("_row") >= n)).drop("_before").join(tails, "_row", "left")
    latest = inside.unionByName(heads)
    share = (F.col("_positive") - F.coalesce(F.col("_before"), F.lit(0))) / F.lit(n)
    base = F.col("_base")
    value = psi_term(base["true"], share + eps) + psi_term(base["false"], 1 - share + eps)
    return latest.withColumn("_base", _shares_struct(baseline, eps)).select(ts, tie, value.alias("psi"))
