"""Alert rules: a comparison that must hold for a while before it fires."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from addrwatch import config
from addrwatch.functions.dates import from_seconds, micros
from addrwatch.operators.rates import seconds

COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def held_condition(
    ticks: DataFrame,
    condition: Column,
    by: Sequence[str] = (),
    hold: int = 60,
    step: int = config.EVALUATION_SECONDS,
    tick: str = "tick",
    moment: Column | None = None,
) -> DataFrame:
    """``(tick, *by, state)`` of every tick in ``ticks``: inactive, pending or firing.

    ``ticks`` has one row per series and evaluation time, ``step`` seconds apart. A
    true tick fires once ``hold`` seconds of ticks before it were true as well; a
    tick that is absent counts as false. Each tick is added to the few later ones
    it can support, which a windowed count does for tables and streams alike, and
    no series is ever gathered as a whole.

    ``moment`` is a time within the step that ends at the tick; a stream passes the
    window time that carries its watermark.
    """
    if hold % step:
        raise ValueError("the hold must be a whole number of steps")
    needed = hold // step + 1
    if moment is None:
        moment = F.timestamp_add("MICROSECOND", F.lit(-1), F.col(tick))
    held = (
        ticks.select(tick, *by, moment.alias("_moment"), F.coalesce(condition, F.lit(False)).alias("_true"))
        .groupBy(F.window("_moment", seconds(hold + step), seconds(step)).alias("_span"), *by)
        .agg(F.count_if("_true").alias("_held"), F.max(F.struct(tick, "_true")).alias("_last"))
    )
    end = F.col("_span.end")
    state = (
        F.when(~F.col("_last._true"), "inactive")
        .when(F.col("_held") >= needed, "firing")
        .otherwise("pending")
    )
    return held.filter(F.col("_last")[tick] == end).select(end.alias(tick), *by, state.alias("state"))


def rate_ticks(rates: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(tick, *by, value)``: a window's rate is known when the window ends."""
    return rates.select(F.col("window_end").alias("tick"), *by, F.col("rate").alias("value"))


def gauge_ticks(
    samples: DataFrame,
    by: Sequence[str] = (),
    step: int = config.EVALUATION_SECONDS,
    ts: str = "ts",
    value: str = "value",
    tie: str | None = None,
    until: Column | None = None,
) -> DataFrame:
    """``(tick, *by, value)`` on every evaluation time from a series' first sample to
    ``until``, a time that defaults to the last sample of all: the latest value at
    or before the tick. Samples after ``until`` are left out.

    Samples are reduced to the last one per series and tick before the shuffle, and each of them covers the ticks up
    to the next one. That is found inside a series' day; only the last tick of a day looks for the first one of a later
    day, in a scan with one row per series and day. So a series without labels is spread over its days.
    """
    number = F.ceil(micros(F.col(ts)) / F.lit(step * 1_000_000.0)).cast("bigint")
    latest = F.struct(ts, *([tie] if tie else []))
    per_tick = samples.groupBy(*by, number.alias("_tick")).agg(F.max_by(value, latest).alias(value))
    if until is None:
        end = samples.agg(F.max(number)).scalar()
    else:
        end = F.ceil(micros(until) / F.lit(step * 1_000_000.0)).cast("bigint")
    day = Window.partitionBy(*by, "_day")
    marked = per_tick.withColumns({"_end": end, "_day": F.floor(F.col("_tick") * step / 86_400)}).filter(F.col("_tick") <= F.col("_end")).withColumns({
        "_next": F.lead("_tick").over(day.orderBy("_tick")) - 1, "_first": F.min("_tick").over(day)})
    days = Window.partitionBy(*by).orderBy("_day")
    last = marked.filter(F.col("_next").isNull()).withColumn("_next", F.coalesce(F.lead("_first").over(days) - 1, F.col("_end")))
    spans = marked.filter(F.col("_next").isNotNull()).unionByName(last)
    ticks = spans.select(*by, value, F.explode(F.sequence("_tick", "_next")).alias("_tick"))
    return ticks.select(from_seconds(F.col("_tick") * step).alias("tick"), *by, value)


def selected(rule: config.AlertRule) -> Column:
    """Whether a row belongs to a series the rule watches."""
    matches = F.lit(True)
    for label, value in rule.where:
        matches &= F.col(label) == value
    return matches


def alerts(ticks: DataFrame, rule: config.AlertRule, moment: Column | None = None) -> DataFrame:
    """``(tick, *by, state, alert, severity)`` of one rule over those series of its
    metric's ticks that it watches."""
    ticks = ticks.filter(selected(rule))
    condition = COMPARE[rule.comparison](F.col("value"), F.lit(rule.threshold)) & ~F.isnan("value")
    held = held_condition(ticks, condition, rule.by, rule.hold, rule.step, moment=moment)
    return held.select(
        "tick", *rule.by, "state",
        F.lit(rule.alert).alias("alert"), F.lit(rule.severity).alias("severity"),
    )


def active_alerts(states: DataFrame) -> DataFrame:
    """``(tick, n)``: alerts firing at each time."""
    return states.filter(F.col("state") == "firing").groupBy("tick").agg(F.count(F.lit(1)).alias("n"))
