from __future__ import annotations

import dataclasses
import glob
import os
from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from addrwatch import config, schemas
from addrwatch.catalog.fixed_model import FIXED
from addrwatch.operators import alerts, drift as drift_ops, lookups as lookup_ops, rates
from addrwatch.plans import serving
from addrwatch.sources import tables
from addrwatch.streaming import drift, held, lookups, scoring, windows

T0 = datetime(2024, 1, 1)
STATS = {c: (1.0, 2.0) for c in config.Z_SCORE_COLS}


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def write_batches(spark, tmp_path, schema, *batches):
    """One file per batch, in order of time."""
    folder = str(tmp_path / f"in-{len(os.listdir(tmp_path))}")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for f in glob.glob(f"{folder}/*.parquet"):
            if os.path.getmtime(f) > i + 1000:
                os.utime(f, (i + 1, i + 1))
    return folder


def stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, stream, tmp_path):
    out = str(tmp_path / f"out-{len(os.listdir(tmp_path))}")
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{out}/rows")
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def test_scoring_stream_equals_batch(spark, tmp_path):
    rows = [(f"r{i}", at(i), float(i % 20), .01 * i, float(i), 0.0, 2.0 if i % 4 else None, -50.0 + 9 * i) for i in range(40)]
    path = str(tmp_path / "requests")
    df = spark.createDataFrame(rows, schemas.REQUEST)
    df.repartition(4).write.json(path)
    stream = tables.read_requests(spark, path, streaming=True, max_files=1)
    got = run(spark, scoring.score_stream(stream, STATS, FIXED), tmp_path)
    want = serving.score(tables.read_requests(spark, path), STATS, FIXED)
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.count() == 30
    rejected = run(spark, scoring.rejected_stream(stream), tmp_path)
    assert {r["request_id"] for r in rejected.collect()} == {f"r{i}" for i in range(0, 40, 4)}


def test_absent_json_fields_are_rejected(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"request_id": "q", "length": 1.0}\n')
    stream = tables.read_requests(spark, str(tmp_path / "in"), streaming=True)
    row = run(spark, scoring.rejected_stream(stream), tmp_path).first()
    assert row["missing_fields"] == config.RAW_FEATURES[1:]


EVENTS = "ts timestamp, label string, bad boolean"


def events():
    early = [(at(s), "x", s % 2 == 0) for s in range(0, 300, 4)]
    late = [(at(s), "x", False) for s in range(300, 600, 5)] + [(at(298), "x", True)]
    return early, late, [(at(900), "y", False)]


@pytest.mark.parametrize("only_bad", [False, True])
def test_stream_rates_equal_batch(spark, tmp_path, only_bad):
    folder = write_batches(spark, tmp_path, EVENTS, *events())
    condition = F.col("bad") if only_bad else None
    got = run(spark, windows.windowed_counts(
        stream_of(spark, folder, EVENTS), 60, 15, ["label"], "30 seconds", condition=condition), tmp_path)
    want = rates.sliding_rate(spark.read.parquet(folder), 60, 15, ["label"], condition=condition)
    closed = want.filter(F.col("window_end") <= at(870))
    assert got.count() > 0
    assert sorted(got.collect()) == sorted(closed.collect())


def test_alert_stream_equals_batch(spark, tmp_path):
    folder = write_batches(spark, tmp_path, EVENTS, *events())
    rule = dataclasses.replace(config.rule("HighRansomwarePredictionRate"), window=60, threshold=.22, where=())
    got = run(spark, windows.alert_stream(stream_of(spark, folder, EVENTS), rule, "30 seconds"), tmp_path)
    counted = rates.sliding_rate(spark.read.parquet(folder), 60, 15, ["label"])
    want = alerts.alerts(alerts.rate_ticks(counted, ["label"]), rule).filter(F.col("tick") <= at(870))
    rows = sorted(got.collect())
    assert rows == sorted(want.collect())
    assert {r["state"] for r in rows} == {"inactive", "pending", "firing"}


def test_gauge_alert_stream(spark, tmp_path):
    schema = "ts timestamp, instance string, value double"
    first = [(at(s), "i", 40.0 if s >= 30 else 1.0) for s in range(0, 100, 5)]
    second = [(at(s), "i", 40.0 if s < 150 else 1.0) for s in range(100, 200, 5)] + [(at(400), "i", 0.0)]
    folder = write_batches(spark, tmp_path, schema, first, second)
    stream = windows.gauge_alert_stream(stream_of(spark, folder, schema), config.rule("ModelLoadingFailure"), "10 seconds")
    got = {int((r["tick"] - T0).total_seconds()): r["state"] for r in run(spark, stream, tmp_path).collect()}
    assert got[15] == "inactive" and got[30] == "pending" and got[75] == "pending"
    assert got[90] == "firing" and got[135] == "firing" and got[150] == "inactive"


def test_a_gauge_sampled_once_a_minute_fires_as_in_a_table(spark, tmp_path):
    schema = "ts timestamp, target string, value double, n int"
    first = [(at(60 * m + 7), "t", .5 if m > 2 else 0.0, 1) for m in range(8)]
    second = [(at(60 * m + 7), "t", .5, 1) for m in range(8, 12)] + [(at(667), "t", 0.0, 2), (at(1200), "t", 0.0, 1)]
    folder = write_batches(spark, tmp_path, schema, first, second)
    rule = config.rule("HighPSIDrift")
    stream = windows.gauge_alert_stream(stream_of(spark, folder, schema), rule, "10 seconds", tie="n")
    got = {r["tick"]: r["state"] for r in run(spark, stream, tmp_path).collect()}
    ticks = alerts.gauge_ticks(spark.read.schema(schema).parquet(folder), ["target"], tie="n", until=F.lit(at(1190)))
    want = {r["tick"]: r["state"] for r in alerts.alerts(ticks, rule).collect() if r["tick"] <= at(667 + 300)}
    assert {k: v for k, v in got.items() if k <= at(667 + 300)} == want
    firing = sorted(int((k - T0).total_seconds()) for k, v in got.items() if v == "firing")
    assert firing[0] == 255 and firing[-1] == 660  # true from 195 on; of two samples at 667 the later one counts


def test_alert_streams_watch_their_series_only(spark, tmp_path):
    schema = "ts timestamp, label string"
    benign = [(at(s), config.BENIGN_LABEL) for s in range(0, 600)]
    folder = write_batches(spark, tmp_path, schema, benign, [(at(1200), config.BENIGN_LABEL)])
    rule = dataclasses.replace(config.rule("HighRansomwarePredictionRate"), window=60)
    assert run(spark, windows.alert_stream(stream_of(spark, folder, schema), rule, "30 seconds"), tmp_path).isEmpty()


def test_drift_stream_follows_the_latest(spark, tmp_path):
    schema = "request_id long, ts timestamp, is_ransomware boolean"
    flags = [i % 3 == 0 for i in range(30)] + [i % 2 == 0 for i in range(30)] + [True] * 10
    rows = [(i, at(i), f) for i, f in enumerate(flags)]
    folder = write_batches(spark, tmp_path, schema, rows[:15], rows[15:40], rows[40:])
    base = spark.createDataFrame([(True, 1), (False, 3)], "value boolean, n long")
    out = str(tmp_path / "drift")
    drift.drift_stream(stream_of(spark, folder, schema), base, out, n=20, period=None).awaitTermination()
    reports = {r["batch"]: r for r in spark.read.parquet(f"{out}/reports").collect()}
    assert reports[0]["status"] == "skipped" and reports[0]["count"] == 15
    for batch, seen in ((1, 40), (2, 70)):
        whole = spark.createDataFrame(rows[:seen], schema)
        want = drift_ops.drift_report(base, whole, n=20).first()
        assert reports[batch]["psi"] == pytest.approx(want["psi"])
    metrics = spark.read.parquet(f"{out}/metrics")
    assert metrics.count() == 2 and metrics.first()["labels"] == {"target": "is_ransomware"}
    assert spark.read.parquet(f"{out}/latest/batch=2").count() == 20


def test_drift_stream_keeps_two_files_of_rows(spark, tmp_path):
    schema = "request_id long, ts timestamp, is_ransomware boolean"
    rows = [(i, at(i), i % 3 == 0) for i in range(48)]
    folder = write_batches(spark, tmp_path, schema, *[rows[i : i + 8] for i in range(0, 48, 8)])
    out = str(tmp_path / "drift")
    base = spark.createDataFrame([(True, 1), (False, 3)], "value boolean, n long")
    drift.drift_stream(stream_of(spark, folder, schema), base, out, n=10, period=None).awaitTermination()
    assert len(glob.glob(f"{out}/latest/*/*.parquet")) == 2
    assert sorted(r["request_id"] for r in spark.read.parquet(f"{out}/latest/batch=5").collect()) == list(range(38, 48))
    assert len(glob.glob(f"{out}/reports/*/*.parquet")) == spark.read.parquet(f"{out}/reports").count() == 6


def test_lookup_stream_serves_each_prediction_once(spark, tmp_path):
    asked_schema, given_schema = "lookup_id long, ts timestamp, request_id string", "request_id string, ts timestamp"
    asked = write_batches(
        spark, tmp_path, asked_schema,
        [(1, at(1), "a"), (2, at(9), "a"), (3, at(9), "b")],
        [(4, at(20), "a"), (5, at(21), "b"), (6, at(22), "b"), (7, at(23), "never")],
        [(8, at(30), "c"), (9, at(31), "a")])
    given = write_batches(
        spark, tmp_path, given_schema, [("a", at(5)), ("c", at(6))], [("b", at(15))], [("d", at(29))])
    stream = lookups.explain_stream(
        stream_of(spark, asked, asked_schema), stream_of(spark, given, given_schema))
    got = {r["lookup_id"]: r["hit"] for r in run(spark, stream, tmp_path).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False, 5: True, 6: False, 7: False, 8: True, 9: False}
    batch = lookup_ops.explain_lookup(spark.read.parquet(asked), spark.read.parquet(given))
    assert got == {r["lookup_id"]: r["hit"] for r in batch.collect()}


def test_telemetry_stream_appends(spark, tmp_path):
    schema = "request_id string, ts timestamp, prediction int, confidence double"
    folder = write_batches(spark, tmp_path, schema, [("a", at(1), 1, .9)], [("b", at(2), 0, .1)])
    records = scoring.telemetry_stream(stream_of(spark, folder, schema))
    path = str(tmp_path / "telemetry")
    for _ in range(2):  # the second run finds nothing new
        tables.append_telemetry(records, path, str(tmp_path / "cp")).awaitTermination()
    rows = tables.read_telemetry(spark, path).orderBy("timestamp").collect()
    assert [(r["is_ransomware"], r["confidence"]) for r in rows] == [(True, .9), (False, .1)]


def test_lookup_stream_with_odd_ids_and_a_limit(spark, tmp_path):
    schema = "kind string, lookup_id string, request_id string, ts timestamp"
    first = [("p", None, None, at(0)), ("p", None, "a\nb", at(0)), ("p", None, "old", at(0)), ("p", None, "None", at(1)),
             ("l", "x1", None, at(5)), ("l", "x2", "a\nb", at(6)), ("l", "x3", "a\nb", at(7))]
    second = [("l", "x4", "old", at(900)), ("l", "x5", "None", at(30)), ("l", "x6", "a", at(30))]
    folder = write_batches(spark, tmp_path, schema, first, second)
    stream = stream_of(spark, folder, schema)
    served = lookups.explain_stream(
        stream.filter("kind = 'l'").select("lookup_id", "request_id", "ts"),
        stream.filter("kind = 'p'").select("request_id", "ts"))
    got = {r["lookup_id"]: r["hit"] for r in run(spark, served, tmp_path).collect()}
    assert got == {"x1": False, "x2": True, "x3": False, "x4": True, "x5": True, "x6": False}


def test_open_predictions_expire(spark, tmp_path):
    schema = "kind string, lookup_id long, request_id string, ts timestamp"
    folder = write_batches(spark, tmp_path, schema, [("p", None, "a", at(0)), ("p", None, "b", at(500))],
                           [("p", None, "c", at(700))], [("l", 1, "a", at(710)), ("l", 2, "b", at(710))])
    stream = stream_of(spark, folder, schema)
    served = lookups.explain_stream(
        stream.filter("kind = 'l'").select("lookup_id", "request_id", "ts"),
        stream.filter("kind = 'p'").select("request_id", "ts"), keep=300)
    assert {r["lookup_id"]: r["hit"] for r in run(spark, served, tmp_path).collect()} == {1: False, 2: True}


def test_a_trigger_reads_the_state_of_its_own_ids(spark, tmp_path):
    """2,000 open ids; the second trigger asks for one of them, the third after it was taken."""
    schema = "kind string, lookup_id long, request_id string, ts timestamp"
    given = [("p", None, f"r{i}", at(0)) for i in range(2000)]
    folder = write_batches(spark, tmp_path, schema, given, [("l", 1, "r7", at(5)), ("l", 2, "r7", at(6))], [("l", 3, "r7", at(7))])
    stream = stream_of(spark, folder, schema)
    served = lookups.explain_stream(
        stream.filter("kind = 'l'").select("lookup_id", "request_id", "ts"),
        stream.filter("kind = 'p'").select("request_id", "ts"))
    query = (served.writeStream.format("parquet").option("path", str(tmp_path / "rows"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    work = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["numInputRows"]]
    assert [w["rocksdbPutCount"] >= 2000 for w in work] == [True, False, False]
    assert max(w["rocksdbGetCount"] + w["rocksdbPutCount"] for w in work[1:]) < 100
    got = {r["lookup_id"]: r["hit"] for r in spark.read.parquet(str(tmp_path / "rows")).collect()}
    assert got == {1: True, 2: False, 3: False}


class CountedMap:
    """Map state in memory that counts what is read and written."""

    def __init__(self):
        self.held, self.reads, self.writes = {}, 0, 0

    def getValue(self, key):
        self.reads += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self.held[key] = value

    def removeKey(self, key):
        self.writes += 1
        del self.held[key]


def test_a_group_of_ids_is_matched_at_once():
    """1,000 ids in one call; every second one is looked up in the same trigger and costs no state."""
    made = CountedMap()
    group = lookups.OpenPredictions(None)
    group.init(SimpleNamespace(getMapState=lambda *_: made))

    def call(rows):
        names = ["request_id", "lookup_id", "named", "made", "at"]
        found = pd.concat(group.handleInputRows((0,), iter([pd.DataFrame(rows, columns=names)]), None))
        return {r.lookup_id: bool(r.hit) for r in found.itertuples()}

    given = [(f"r{i}", 0, False, True, 10) for i in range(1000)]
    asked = [(f"r{i}", i, True, False, 10 + i % 3) for i in range(0, 1000, 2)]
    assert call(given + asked) == {i: True for i in range(0, 1000, 2)}
    assert (made.reads, made.writes, len(made.held)) == (0, 500, 500)
    assert call([("r1", 7, True, False, 11), ("r1", 8, True, False, 10), ("r0", 9, True, False, 11), ("r3", 10, True, False, 9)]) == {
        7: False, 8: True, 9: False, 10: False}
    assert (made.reads, made.writes, len(made.held)) == (3, 501, 499)


def test_lookup_stream_without_times_or_names(spark, tmp_path):
    schema = "kind string, lookup_id long, request_id string, ts timestamp"
    folder = write_batches(spark, tmp_path, schema, [
        ("p", None, "a", at(0)), ("p", None, "b", at(0)), ("p", None, "c", None), ("l", 1, "a", None), ("l", 2, "a", at(2)),
        ("l", 2**60 + 1, "a", at(3)), ("l", None, "b", at(4)), ("l", 3, "b", at(5)), ("l", 4, "c", at(5))])
    stream = stream_of(spark, folder, schema)
    served = lookups.explain_stream(
        stream.filter("kind = 'l'").select("lookup_id", "request_id", "ts"), stream.filter("kind = 'p'").select("request_id", "ts"))
    got = {r["lookup_id"]: r["hit"] for r in run(spark, served, tmp_path).collect()}
    assert got == {1: False, 2: True, 2**60 + 1: False, None: True, 3: False, 4: False}


def test_state_of_open_predictions_goes_group_by_group(spark, tmp_path):
    """One group: its timer drops what is over and wakes it up again for the others."""
    schema = "kind string, lookup_id long, request_id string, ts timestamp"
    first = [("p", None, f"r{i}", at(i)) for i in range(100)]
    folder = write_batches(spark, tmp_path, schema, first, *[[("l", 1000 + t, f"r{t - 150}", at(t))] for t in (195, 230, 270, 400, 401)])
    stream = stream_of(spark, folder, schema)
    served = lookups.explain_stream(
        stream.filter("kind = 'l'").select("lookup_id", "request_id", "ts"),
        stream.filter("kind = 'p'").select("request_id", "ts"), keep=80, groups=1)
    query = (served.writeStream.format("parquet").option("path", str(tmp_path / "rows"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) >= 100 and held[-1] <= 3
    rows = spark.read.parquet(str(tmp_path / "rows")).collect()
    assert rows and not any(r["hit"] for r in rows)


def test_a_series_that_falls_silent_ends_on_time(spark, tmp_path):
    """Only events of other series move the watermark after the first file."""
    schema = "ts timestamp, label string"
    first = [(at(s), config.POSITIVE_LABEL) for s in range(0, 300)] + [(at(300), config.BENIGN_LABEL)]
    others = [[(at(600 * k), config.BENIGN_LABEL)] for k in range(1, 4)]
    folder = write_batches(spark, tmp_path, schema, first, *others)
    rule = dataclasses.replace(config.rule("HighRansomwarePredictionRate"), window=60)
    got = sorted(run(spark, windows.alert_stream(stream_of(spark, folder, schema), rule, "30 seconds"), tmp_path).collect())
    counted = rates.sliding_rate(spark.read.parquet(folder), 60, 15, ["label"])
    assert got == sorted(alerts.alerts(alerts.rate_ticks(counted, ["label"]), rule).collect())
    assert got[-1]["tick"] == at(345) and {r["label"] for r in got} == {config.POSITIVE_LABEL}


def test_a_gauge_goes_on_while_other_series_move_the_watermark(spark, tmp_path):
    schema = "ts timestamp, instance string, value double"
    folder = write_batches(spark, tmp_path, schema, [(at(10), "a", 40.0), (at(12), "b", 1.0)], [(at(200), "b", 50.0)], [(at(280), "b", 50.0), (at(281), "c", None)])
    stream = windows.gauge_alert_stream(stream_of(spark, folder, schema), config.rule("ModelLoadingFailure"), "0 seconds", stale=90)
    got = {(r["instance"], int((r["tick"] - T0).total_seconds())): r["state"] for r in run(spark, stream, tmp_path).collect()}
    a = {15 * k: "pending" if k < 5 else "firing" for k in range(1, 8)}
    assert {k: v for (i, k), v in got.items() if i == "a"} == a  # stale after 105
    assert {k: v for (i, k), v in got.items() if i == "b"} == {
        **{15 * k: "inactive" for k in range(1, 8)}, **{k: "pending" for k in (210, 225, 240, 255)}, 270: "firing"}
    assert not any(i == "c" for i, _ in got)


def test_hit_rate_alerts_follow_all_lookups_so_far(spark, tmp_path):
    schema = "lookup_id long, ts timestamp, hit boolean"
    first = [(n, at(7 * n), n % 3 > 0) for n in range(40)] + [(900, at(15), True), (901, at(15), False)]
    second = [(n, at(7 * n), n > 90) for n in range(40, 150)] + [(950, None, True)]
    folder = write_batches(spark, tmp_path, schema, first, second, [(999, at(3000), None)])
    rule = dataclasses.replace(config.rule("LowCacheHitRate"), step=15, hold=60)
    got = {r["tick"]: r["state"] for r in run(
        spark, windows.hit_rate_alert_stream(stream_of(spark, folder, schema), rule, "10 seconds", stale=600), tmp_path).collect()}
    running = lookup_ops.running_hit_rate(spark.read.schema(schema).parquet(folder).filter("ts IS NOT NULL"))
    ticks = alerts.gauge_ticks(running.withColumn("value", F.col("hit_rate")), (), rule.step, tie="lookup_id", until=F.lit(at(1600)))
    want = {r["tick"]: r["state"] for r in alerts.alerts(ticks, rule).collect()}
    upto = at(149 * 7 + 500)
    assert {k: v for k, v in got.items() if k <= upto} == {k: v for k, v in want.items() if k <= upto}
    assert len(set(got.values())) == 3
    assert max(got) < at(149 * 7 + 600 + rule.step)  # nobody looked anything up after that


@pytest.mark.parametrize("window", [None, 60])
def test_ticks_are_the_same_however_they_are_cut(window):
    rule = dataclasses.replace(config.rule("HighPSIDrift"), window=window, threshold=0.05, hold=45)
    rng = np.random.default_rng(4)
    ticks = np.unique(rng.integers(1, 400, 120))
    readings = rng.choice([0.0, 1.0, 6.0, np.nan if window is None else 2.0], len(ticks))
    whole = held.advance(held.Series(None, 0, ticks, readings), rule, 450, 90)
    expected = {}
    run_length, before = 0, None
    for tick in range(1, 451):
        near = [i for i, t in enumerate(ticks) if t <= tick and tick - t <= (6 if window is None else 3)]
        if not near:
            continue
        value = readings[near[-1]] if window is None else sum(readings[near]) / 60
        run_length = (run_length if before == tick - 1 else 0) + 1 if value > rule.threshold else 0
        before = tick
        expected[tick] = "inactive" if not run_length else "firing" if run_length >= 4 else "pending"
    assert dict(zip(whole[1].tolist(), whole[2].tolist(), strict=True)) == expected
    assert {"inactive", "pending", "firing"} == set(expected.values())
    parts, series, seen = {}, held.Series(None, 0, ticks[:0], readings[:0]), 0
    for last in sorted(rng.integers(0, 450, 40).tolist()) + [450]:
        new = (ticks > seen) & (ticks <= last)
        seen = max(seen, last)
        given = held.Series(series.done, series.run, np.concatenate((series.ticks, ticks[new])), np.concatenate((series.readings, readings[new])))
        series, out, states = held.advance(given, rule, last, 90)
        parts |= dict(zip(out.tolist(), states.tolist(), strict=True))
    assert parts == expected
