from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from addrwatch import config
from addrwatch.functions import dates, labels
from addrwatch.plans import monitoring
from addrwatch.operators import alerts, drift, monitor, rates, requests as checks

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def telemetry(spark, flags):
    rows = [(i, at(i), f) for i, f in enumerate(flags)]
    return spark.createDataFrame(rows, "request_id long, ts timestamp_ntz, is_ransomware boolean")


def baseline(spark, true, false):
    return spark.createDataFrame([(True, true), (False, false)], "value boolean, n long")


def test_short_telemetry_is_skipped(spark):
    row = drift.drift_report(baseline(spark, 1, 5), telemetry(spark, [True] * 99)).first()
    assert (row["status"], row["reason"], row["count"], row["psi"]) == ("skipped", "insufficient_data", 99, None)


def test_no_positives_among_the_latest(spark):
    row = drift.drift_report(baseline(spark, 20, 80), telemetry(spark, [True] * 5 + [False] * 100)).first()
    base, live, eps = (.2, .8), (0.0, 1.0), 1e-6
    want = sum((l - b) * math.log((l + eps) / (b + eps)) for b, l in zip(base, live))
    assert row["status"] == "success" and row["count"] == 100
    assert row["psi"] == pytest.approx(want)
    assert row["latest_true"] == pytest.approx(eps)


def test_drift_series_matches_a_report_at_each_time(spark):
    flags = [i % 3 == 0 or i > 60 for i in range(90)]
    series = {r["request_id"]: r["psi"] for r in drift.drift_series(
        baseline(spark, 1, 2), telemetry(spark, flags), n=20, rows_per_range=8).collect()}
    assert sorted(series) == list(range(19, 90))
    for i in (19, 40, 89):
        report = drift.drift_report(baseline(spark, 1, 2), telemetry(spark, flags[: i + 1]), n=20).first()
        assert series[i] == pytest.approx(report["psi"])


def test_severity_limits_are_strict(spark):
    df = spark.createDataFrame([(.1,), (.11,), (.2,), (.21,)], "psi double")
    got = [r[0] for r in df.select(labels.drift_severity(F.col("psi"))).collect()]
    assert got == ["none", "warning", "warning", "critical"]


def test_risk_levels(spark):
    df = spark.createDataFrame([(1, .9), (1, .89), (1, .7), (1, .5), (0, .95)], "prediction int, confidence double")
    got = [r[0] for r in df.select(labels.risk_level(F.col("prediction"), F.col("confidence"))).collect()]
    assert got == ["very high", "high", "high", "medium", "low"]


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(.1,), (.2,), (.95,), (1.0,)], "confidence double")
    got = {r["le"]: r["n"] for r in monitor.confidence_histogram(df).collect()}
    assert got == {"0.1": 1, "0.3": 2, "0.5": 2, "0.7": 2, "0.9": 2, "1.0": 4, "+Inf": 4}


def requests(spark, *rows):
    return spark.createDataFrame(rows, "request_id string, length double, weight double, count double, looped double, neighbors double, income double")


def test_request_checks(spark):
    df = requests(spark, ("only", 1.0, None, None, None, None, None), ("neg", -1.0, -1.0, -1.0, -1.0, -1.0, -1.0),
                  ("one", 1.0, 4.0, 2.0, 0.0, 2.0, -100.0), ("ok", 1.0, 4.0, 2.0, 0.0, 2.0, 100.0))
    rejected = checks.rejected_requests(df).collect()
    assert [(r["request_id"], r["missing_fields"]) for r in rejected] == [("only", config.RAW_FEATURES[1:])]
    assert checks.valid_requests(df).count() == 3
    counts = {r["quality_rule"]: r["n"] for r in checks.quality_counts(df).collect()}
    assert counts == {f"neg_{c}": 2 if c == "income" else 1 for c in config.RAW_FEATURES}
    assert checks.quality_issues(df).count() == 7


def test_telemetry_time_has_a_fixed_offset(spark):
    df = spark.createDataFrame([(datetime(2024, 6, 30, 23, 30, 0, 5),)], "ts timestamp_ntz")
    assert df.select(dates.telemetry_time(F.col("ts"))).first()[0] == "2024-07-01T00:30:00.000005+01:00"
    assert df.select(dates.telemetry_time()).first()[0].endswith("+01:00")


def test_rate_windows_match_brute_force(spark):
    events = [3, 14, 15, 16, 61, 62, 200]
    df = spark.createDataFrame([(at(s),) for s in events], "ts timestamp_ntz")
    got = {r["window_start"]: r["n"] for r in rates.sliding_rate(df, 60, 15).collect()}
    want = {}
    for start in range(-60, 210, 15):
        n = sum(start <= s < start + 60 for s in events)
        if n:
            want[at(start)] = n
    assert got == want


def states(spark, truth, **kw):
    rows = [(at(15 * i), "s", float(v)) for i, v in truth]
    ticks = spark.createDataFrame(rows, "tick timestamp_ntz, name string, value double")
    held = alerts.held_condition(ticks, F.col("value") > 0, ["name"], **kw)
    return {int((r["tick"] - T0).total_seconds()) // 15: r["state"] for r in held.collect()}


def test_alert_fires_after_the_hold(spark):
    got = states(spark, [(0, 0), *[(i, 1) for i in range(1, 7)], (7, 0), (8, 1)])
    assert got == {0: "inactive", 1: "pending", 2: "pending", 3: "pending", 4: "pending", 5: "firing",
                   6: "firing", 7: "inactive", 8: "pending"}


def test_missing_tick_breaks_the_hold(spark):
    got = states(spark, [(i, 1) for i in (0, 1, 2, 4, 5, 6, 7, 8)])
    assert got[7] == "pending" and got[8] == "firing" and 3 not in got


def test_gauge_keeps_its_last_value(spark):
    rows = [(at(1), "a", 1.0), (at(14), "a", 2.0), (at(46), "a", 3.0), (at(30), "b", 9.0), (at(90), "b", 8.0)]
    samples = spark.createDataFrame(rows, "ts timestamp_ntz, name string, value double")
    got = {(r["name"], int((r["tick"] - T0).total_seconds())): r["value"] for r in alerts.gauge_ticks(samples, ["name"]).collect()}
    assert got == {
        ("a", 15): 2.0, ("a", 30): 2.0, ("a", 45): 2.0, ("a", 60): 3.0, ("a", 75): 3.0, ("a", 90): 3.0,
        ("b", 30): 9.0, ("b", 45): 9.0, ("b", 60): 9.0, ("b", 75): 9.0, ("b", 90): 8.0,
    }


def test_low_gauge_rule(spark):
    rows = [(at(0), 90.0), (at(20), 40.0), (at(200), 80.0)]
    samples = spark.createDataFrame(rows, "ts timestamp_ntz, value double")
    rule = config.rule("LowCacheHitRate")
    found = alerts.alerts(alerts.gauge_ticks(samples), rule)
    got = {int((r["tick"] - T0).total_seconds()): r["state"] for r in found.collect()}
    assert got[15] == "inactive" and got[30] == "pending" and got[75] == "pending" and got[90] == "firing"
    assert got[195] == "firing" and got[210] == "inactive"
    active = alerts.active_alerts(found).filter(F.col("tick") == at(105)).first()
    assert active["n"] == 1


def test_every_rule_is_known():
    assert len(config.ALERT_RULES) == 10
    assert all(r.hold == 60 and r.step == 15 for r in config.ALERT_RULES)


def test_samples_after_the_end_are_left_out(spark):
    rows = [(at(15), "a", 1.0), (at(75), "a", 9.0), (at(80), "b", 9.0)]
    samples = spark.createDataFrame(rows, "ts timestamp_ntz, name string, value double")
    got = sorted((r["name"], int((r["tick"] - T0).total_seconds()), r["value"])
                 for r in alerts.gauge_ticks(samples, ["name"], until=F.lit(at(45))).collect())
    assert got == [("a", 15, 1.0), ("a", 30, 1.0), ("a", 45, 1.0)]


def test_all_rules_run_over_their_metrics(spark):
    flat = {"job": "j", "instance": "i", "quality_rule": "q", "target": "t"}
    names = {r.metric: r.by for r in config.ALERT_RULES}

    def ticks(metric, value, **labels):
        by = names[metric]
        rows = [(at(15 * k), *[labels.get(b, flat.get(b, "x")) for b in by], value) for k in range(8)]
        return spark.createDataFrame(rows, f"tick timestamp_ntz, {''.join(f'{b} string, ' for b in by)}value double")

    quiet = {m: ticks(m, 60.0 if m == "hit_rate" else 0.0) for m in names}
    benign = quiet | {"predictions": ticks("predictions", 9.0, label=config.BENIGN_LABEL),
                      "risk_levels": ticks("risk_levels", 9.0, confidence_level=config.LOW_RISK)}
    assert monitoring.alert_states(benign).filter("state <> 'inactive'").isEmpty()
    loud = {m: ticks(m, 1e10 if m != "hit_rate" else 1.0, label=config.POSITIVE_LABEL, confidence_level=config.VERY_HIGH_RISK[1]) for m in names}
    active = {r["tick"]: r["n"] for r in alerts.active_alerts(monitoring.alert_states(loud)).collect()}
    assert active == {at(15 * k): 10 for k in range(4, 8)}
    with pytest.raises(ValueError):
        monitoring.alert_states({"psi": quiet["psi"]})
