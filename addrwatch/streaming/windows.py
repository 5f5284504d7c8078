"""Event-time rates and held alerts on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from addrwatch import config
from addrwatch.functions.labels import label_name, risk_level
from addrwatch.operators import alerts, rates
from addrwatch.streaming import state
from addrwatch.streaming.held import HeldTicks, RunningShareTicks


def watermarked(stream: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Event times as instants, which watermarks need, with the allowed lateness."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def windowed_counts(
    stream: DataFrame,
    window: int,
    slide: int,
    by: Sequence[str] = (),
    delay: str = "1 minute",
    ts: str = "ts",
    condition: Column | None = None,
) -> DataFrame:
    """``sliding_rate`` of a stream; a window comes out once the watermark passes it."""
    return rates.sliding_rate(watermarked(stream, delay, ts), window, slide, by, ts, condition)


def prediction_stream_rate(stream: DataFrame, window: int, slide: int, delay: str = "1 minute") -> DataFrame:
    named = stream.withColumn("label", label_name(F.col("prediction")))
    return windowed_counts(named, window, slide, ["label"], delay)


def risk_stream_rate(stream: DataFrame, window: int, slide: int, delay: str = "1 minute") -> DataFrame:
    leveled = stream.withColumn("confidence_level", risk_level(F.col("prediction"), F.col("confidence")))
    return windowed_counts(leveled, window, slide, ["confidence_level"], delay)


def quality_stream_rate(
    stream: DataFrame, window: int, slide: int, delay: str = "1 minute", ts: str = "ts"
) -> DataFrame:
    return rates.quality_rate(watermarked(stream, delay, ts), window, slide, ts)


def http_error_stream_rate(stream: DataFrame, window: int, slide: int, delay: str = "1 minute") -> DataFrame:
    return windowed_counts(stream, window, slide, ["job", "instance"], delay, condition=rates.is_http_error())


def alert_stream(
    stream: DataFrame,
    rule: config.AlertRule,
    delay: str = "1 minute",
    ts: str = "ts",
    condition: Column | None = None,
) -> DataFrame:
    """``(tick, *by, state, alert, severity)`` of a rate rule over the events of a stream
    that meet the condition and belong to a series the rule watches.

    Events are counted in panes of one step, and each series' panes go on to keyed state (``held``).
    All events move the watermark, also those of series the rule doesn't watch: what it watches
    is a condition of the count, since a filter on the series would be moved before the
    watermark. A tick comes out once the watermark passes it, whether its series goes on or not.
    """
    if rule.window % rule.step:
        raise ValueError("the window must be a whole number of steps")
    watched = alerts.selected(rule) if condition is None else alerts.selected(rule) & condition
    panes = watermarked(stream, delay, ts).groupBy(F.window(ts, rates.seconds(rule.step)).alias("window"), *rule.by).agg(
        F.count_if(watched).alias("_watched"))
    return _held(panes.withColumn("value", F.col("_watched").cast("double")), rule)


def gauge_alert_stream(
    samples: DataFrame,
    rule: config.AlertRule,
    delay: str = "1 minute",
    ts: str = "ts",
    value: str = "value",
    stale: int = 300,
    tie: str | None = None,
) -> DataFrame:
    """The same for a gauge: a tick reads the latest sample at or before it, of equal
    times the one with the greater ``tie``, unless that is more than ``stale`` seconds old.

    Samples are reduced to the last one a tick; what a series read last is kept in its
    state and carried on from tick to tick.
    """
    # The step that ends at a tick holds the tick itself.
    moment = F.timestamp_add("MICROSECOND", F.lit(-1), F.col(ts).cast("timestamp"))
    order = F.struct(F.col(ts).alias("_ts"), *([F.col(tie).alias("_tie")] if tie else []))
    watched = alerts.selected(rule) & F.col(value).isNotNull()
    timed = samples.withColumns({"_moment": moment, "_order": order}).withWatermark("_moment", delay)
    latest = timed.groupBy(F.window("_moment", rates.seconds(rule.step)).alias("window"), *rule.by).agg(
        F.count_if(watched).alias("_watched"), F.max_by(value, F.when(watched, F.col("_order"))).alias("value"))
    return _held(latest, rule, stale)


def hit_rate_alert_stream(
    served: DataFrame, rule: config.AlertRule, delay: str = "1 minute", ts: str = "ts", stale: int = 300
) -> DataFrame:
    """The same for the running hit rate of served look-ups ``(ts, hit)``, as ``explain_stream`` gives them.

    Look-ups are counted in panes of one step; the one series that follows adds up a row per step
    and trigger, however many look-ups there are. A tick reads the share of hits, in percent, among all look-ups up to
    it, unless the last one is more than ``stale`` seconds old. Look-ups without a time and those behind the watermark don't count;
    a look-up without an answer (null ``hit``) is no hit.
    """
    if rule.by:
        raise ValueError("a running hit rate is one series")
    moment = F.timestamp_add("MICROSECOND", F.lit(-1), F.col(ts).cast("timestamp"))
    timed = served.withColumn("_moment", moment).withWatermark("_moment", delay)
    panes = timed.groupBy(F.window("_moment", rates.seconds(rule.step)).alias("window")).agg(
        F.count_if("hit").alias("value"), F.count(F.lit(1)).alias("_watched"))
    return _held(panes, rule, stale, RunningShareTicks)


def _held(readings: DataFrame, rule: config.AlertRule, stale: int = 0, processor: type[HeldTicks] = HeldTicks) -> DataFrame:
    """Alert states of windows of one step that hold a reading of a watched series."""
    if rule.hold % rule.step:
        raise ValueError("the hold must be a whole number of steps")
    state.prepare(readings.sparkSession)
    given = readings.filter(F.col("_watched") > 0).select(
        F.window_time("window").alias("moment"), *rule.by,
        (F.unix_seconds("window.end") / rule.step).cast("bigint").alias("number"), F.col("value").cast("double").alias("value"),
        F.col("_watched").alias("seen"), F.lit(0).alias("_series"))
    kinds = dict(given.dtypes)
    labels = "".join(f"`{name}` {kinds[name]}, " for name in rule.by)
    held = given.groupBy(*(rule.by or ["_series"])).transformWithStateInPandas(
        processor(rule, stale), f"tick timestamp, {labels}state string", "Append", "EventTime", eventTimeColumnName="tick")
    return held.select("tick", *rule.by, "state", F.lit(rule.alert).alias("alert"), F.lit(rule.severity).alias("severity"))
