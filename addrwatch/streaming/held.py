"""Alert states as keyed state: one series a key, one timer for its next tick.

Readings reach a series as ``(tick, value)``, at most one a tick: the events counted in the
step before the tick, or the last sample up to it. State holds the readings that later ticks still need and how
long the condition has held. Ticks up to the watermark are final; a timer at the next one wakes the
series up when the watermark passes it, so a series that falls silent ends on time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from addrwatch import config
from addrwatch.operators.alerts import COMPARE

#: The last tick that came out, for how many ticks the condition has held then, and readings still needed.
_SERIES = "done bigint, run bigint, ticks array<bigint>, readings array<double>"


@dataclass
class Series:
    """What one series' state says; ``done`` is None before its first tick."""

    done: int | None
    run: int
    ticks: np.ndarray
    readings: np.ndarray


def advance(series: Series, rule: config.AlertRule, last: int, stale: int) -> tuple[Series, np.ndarray, np.ndarray]:
    """The series after tick ``last``, and (tick, state) of its ticks since the one that came out before.

    A rate adds up the readings of its window and has a tick while there are any. A gauge's tick has its last reading,
    unless that is older than ``stale`` seconds. A tick fires if the condition held on the ``hold / step`` ticks before it too.
    """
    order = np.argsort(series.ticks, kind="stable")
    ticks, readings = series.ticks[order], series.readings[order]
    reach = stale // rule.step if rule.window is None else rule.window // rule.step - 1
    use = int(np.searchsorted(ticks, last, side="right"))
    first = ticks[:use] if series.done is None else np.maximum(ticks[:use], series.done + 1)
    end = np.minimum(np.minimum(ticks[:use] + reach, last), np.append(ticks[1:use] - 1, last) if use else last)
    n = np.maximum(end - first + 1, 0)
    source = np.repeat(np.arange(use), n)
    out = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    if rule.window is None:
        value = readings[source]
    else:
        upto = np.concatenate(([0.0], np.cumsum(readings[:use])))
        value = (upto[source + 1] - upto[np.searchsorted(ticks[:use], out - reach, side="left")]) / rule.window
    true = COMPARE[rule.comparison](value, rule.threshold) & ~np.isnan(value)

    needed = rule.hold // rule.step + 1
    carried = series.run if len(out) and series.done is not None and out[0] == series.done + 1 else 0
    place = np.arange(len(out))
    begins = np.append(True, (np.diff(out) != 1) | ~true[:-1]) if len(out) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(begins, place, 0)) if len(out) else place
    run = np.where(true, place - begin + 1 + np.where(begin == 0, carried, 0), 0)
    states = np.where(~true, "inactive", np.where(run >= needed, "firing", "pending"))

    keep = ticks + reach > last
    if rule.window is None and use:
        keep[: use - 1] = False  # later ticks read the last of these alone
    done = max(last, series.done if series.done is not None else last)
    ended = int(min(run[-1], needed)) if len(out) and out[-1] == done else 0
    if not len(out) and series.done == done:
        ended = series.run
    return Series(done, ended, ticks[keep], readings[keep]), out, states


class HeldTicks(StatefulProcessor):
    """Turns a series' readings into ``(tick, *by, state)`` of every tick the watermark has passed."""

    def __init__(self, rule: config.AlertRule, stale: int = 0):
        self.rule, self.stale = rule, stale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", _SERIES)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows), ignore_index=True)
        yield from self._until_watermark(key, given["number"].to_numpy(np.int64), given["value"].to_numpy(np.float64), timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._until_watermark(key, np.zeros(0, np.int64), np.zeros(0), timerValues)

    def close(self) -> None:
        pass

    def _until_watermark(self, key: tuple, ticks: np.ndarray, readings: np.ndarray, timer_values) -> Iterator[pd.DataFrame]:
        step = self.rule.step * 1000
        last = timer_values.getCurrentWatermarkInMs() // step
        series = Series(None, 0, ticks, readings)
        if self.state.exists():
            done, run, old_ticks, old_readings = self.state.get()
            series = Series(done, run, np.concatenate((np.array(old_ticks, np.int64), ticks)),
                            np.concatenate((np.array(old_readings, np.float64), readings)))
        series, out, states = advance(series, self.rule, last, self.stale)
        if len(series.ticks):
            self.state.update((series.done, series.run, series.ticks.tolist(), series.readings.tolist()))
            self.handle.registerTimer(max(int(series.ticks.min()), last + 1) * step)
        else:
            self.state.clear()
        if len(out):
            labels = {name: [value] * len(out) for name, value in zip(self.rule.by, key, strict=False)}
            yield pd.DataFrame({"tick": pd.to_datetime(out * self.rule.step, unit="s", utc=True), **labels, "state": states})


class RunningShareTicks(HeldTicks):
    """The same for a share of all events so far, in percent: state adds up the ``value`` and ``seen`` of its steps.

    Steps come out once the watermark passes them, so what comes in one trigger is later than all before it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.totals = handle.getValueState("totals", "part double, seen double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows), ignore_index=True).sort_values("number")
        part, seen = self.totals.get() if self.totals.exists() else (0.0, 0.0)
        part = part + given["value"].cumsum().to_numpy(np.float64)
        seen = seen + given["seen"].cumsum().to_numpy(np.float64)
        self.totals.update((float(part[-1]), float(seen[-1])))
        yield from self._until_watermark(key, given["number"].to_numpy(np.int64), part * 100.0 / seen, timerValues)
