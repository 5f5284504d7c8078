"""Explanation look-ups on streams, with the open predictions as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from addrwatch.functions.dates import from_micros, micros
from addrwatch.streaming import state

#: Groups of ids that are worked on at once. Those of a checkpoint stay as they are.
GROUPS = 1024


class OpenPredictions(StatefulProcessor):
    """The state of a group maps a request id to the time of its prediction until a look-up takes it or its time is over.

    A group's rows of a trigger are matched together; state is read for ids that are looked up without a
    prediction in the same trigger, and written for those that are opened or taken.
    """

    def __init__(self, keep: int | None):
        self.keep = None if keep is None else keep * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.made = handle.getMapState("made", "request_id string", "at bigint")
        if self.keep is not None:
            self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        frame = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        code, ids = pd.factorize(frame["request_id"])
        at, given = frame["at"].to_numpy(np.int64), frame["made"].to_numpy(bool)
        made, new = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        made[code[given]], new[code[given]] = at[given], True
        asked = np.flatnonzero(~given)
        is_open = new.copy()
        for i in np.unique(code[asked][~new[code[asked]]]):
            old = self.made.getValue((ids[i],))
            if old is not None:
                made[i], is_open[i] = old[0], True

        lookup = frame["lookup_id"].to_numpy()
        asked = asked[np.lexsort((lookup[asked], at[asked], code[asked]))]
        of = code[asked]
        fits = is_open[of] & (made[of] <= at[asked])
        if self.keep is not None:
            fits &= at[asked] <= made[of] + self.keep
        fitting = np.flatnonzero(fits)
        taken, first = np.unique(of[fitting], return_index=True)
        hit = np.zeros(len(asked), bool)
        hit[fitting[first]] = True

        is_open[taken] = False
        opened = np.flatnonzero(is_open & new)
        for i in opened:
            self.made.updateValue((ids[i],), (int(made[i]),))
        for i in taken[~new[taken]]:
            self.made.removeKey((ids[i],))
        if self.keep is not None and len(opened) and not self.timer.exists():
            self._wake(int(made[opened].min()))
        if len(asked):
            named = frame["named"].to_numpy(bool)[asked]
            answered = pd.Series(lookup[asked]).convert_dtypes().where(named, None)
            yield pd.DataFrame({"lookup_id": answered, "request_id": ids[of], "at": at[asked], "hit": hit})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Drops what is over and sleeps until the next of the others is."""
        now, left = timerValues.getCurrentWatermarkInMs() * 1000, []
        for request, made in list(self.made.iterator()):
            if made[0] + self.keep < now:
                self.made.removeKey(request)
            else:
                left.append(made[0])
        self.timer.clear()
        if left:
            self._wake(min(left))
        return iter(())

    def close(self) -> None:
        pass

    def _wake(self, made: int) -> None:
        """One timer a group, up to an eighth of the limit late: an id is passed over about ten times at most."""
        step = max(self.keep // 8000, 1)
        due = ((made + self.keep) // 1000 // step + 1) * step
        self.handle.registerTimer(due)
        self.timer.update((due,))


def explain_stream(lookups: DataFrame, predictions: DataFrame, keep: int | None = None, groups: int = GROUPS) -> DataFrame:
    """``(lookup_id, request_id, ts, hit)`` of a stream of look-ups.

    A prediction is state under its request id until a look-up takes it; a trigger
    reads and writes the state of the ids it holds and of no others. Look-ups are served
    trigger by trigger, in time order within one. With a limit, a look-up more than ``keep`` seconds after its
    prediction is a miss, the state goes by a timer once the watermark is that far, and a look-up that is read when the
    newest event is more than ``keep`` seconds ahead of it isn't answered.
    Ids are dealt to ``groups`` by their hash, a number that stays with a checkpoint. A group's rows of one trigger are
    matched at once, so the source's files or offsets per trigger bound what it takes, also for a hot id. A look-up without
    an id or a time is a miss; a prediction without one is never asked for.
    """
    state.prepare(lookups.sparkSession)
    kind = lookups.schema["request_id"].dataType
    number = dict(lookups.dtypes)["lookup_id"] in ("tinyint", "smallint", "int", "bigint")
    name, none = ("bigint", F.lit(0)) if number else ("string", F.lit(""))
    asked = lookups.select("request_id", "ts", F.col("lookup_id").cast(name), F.lit(False).alias("made"))
    given = predictions.select("request_id", "ts", none.cast(name).alias("lookup_id"), F.lit(True).alias("made"))
    whole = F.col("request_id").isNotNull() & F.col("ts").isNotNull()
    both = asked.unionByName(given).filter(whole).select(
        F.col("request_id").cast("string"), F.coalesce("lookup_id", none.cast(name)).alias("lookup_id"),
        F.col("lookup_id").isNotNull().alias("named"), "made", micros(F.col("ts")).alias("at"), F.col("ts").cast("timestamp"))
    if keep is not None:
        both = both.withWatermark("ts", f"{keep} seconds")
    served = both.withColumn("_group", F.pmod(F.xxhash64("request_id"), F.lit(groups))).groupBy("_group").transformWithStateInPandas(
        OpenPredictions(keep), f"lookup_id {name}, request_id string, at bigint, hit boolean",
        "Append", "None" if keep is None else "EventTime",
    ).select("lookup_id", F.col("request_id").cast(kind), from_micros(F.col("at")).alias("ts"), "hit")
    bare = asked.filter(~whole).select(
        "lookup_id", "request_id", from_micros(micros(F.col("ts"))).alias("ts"), F.lit(False).alias("hit"))
    return served.unionByName(bare)
