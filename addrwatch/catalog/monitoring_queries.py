"""Counts, drift, rates, held conditions and alert rules.

The given events are minutes apart, so rates look back an hour in quarter-hour
steps and limits are lower than the configured ones.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from addrwatch import config, views
from addrwatch.catalog.registry import places, query
from addrwatch.catalog.sql import gauge, held, sliding, with_
from addrwatch.functions.labels import drift_severity, is_positive
from addrwatch.operators import alerts, drift, lookups, monitor, rates
from addrwatch.operators.stats import training_baseline
from addrwatch.plans import monitoring
from addrwatch.session import scratch_dir
from addrwatch.sources import tables

HOUR, QUARTER = 3600, 900


def baseline(spark, sf):
    """Class counts of the labels that come with the predictions."""
    return training_baseline(views.pred(spark, sf), target="y")


# ---------------------------------------------------------- telemetry tables


@query("s8_read_telemetry", with_("pred", 'SELECT ts AS "timestamp", prediction = 1 AS is_ransomware, confidence FROM pred'))
def s8(spark, sf):
    path = scratch_dir(spark, "telemetry")
    rows = views.telemetry(spark, sf).withColumnRenamed("ts", "timestamp")
    tables.append_telemetry(rows.filter(config.TARGET), path)
    tables.append_telemetry(rows.filter(~F.col(config.TARGET)), path)
    return tables.read_telemetry(spark, path)


@query("s13_publish_metric", with_("psi_series", """
SELECT 'psi' AS metric, 'is_ransomware' AS target, ts, round(psi, 6) + 0.0 AS value FROM psi_series"""))
def s13(spark, sf):
    path = scratch_dir(spark, "metrics")
    tables.publish_metric(_psi_samples(spark, sf), path)
    return spark.read.parquet(path).select(
        "metric", F.col("labels")["target"].alias("target"), "ts", *places(["value"]))


def _psi_samples(spark, sf):
    series = drift.drift_series(baseline(spark, sf), views.telemetry(spark, sf))
    return tables.metric_samples(
        series.withColumn("target", F.lit(config.TARGET)), "psi", {"target": "target"}, "ts", "psi")


@query("p13_drift_table", with_("psi_series", """
SELECT 'is_ransomware' AS "Feature", round(psi, 6) + 0.0 AS "PSI Score" FROM psi_series"""))
def p13(spark, sf):
    return monitor.drift_table(_psi_samples(spark, sf)).select("Feature", *places(["PSI Score"]))


# -------------------------------------------------------------------- counts


@query("a12_prediction_counts", with_("labelled_pred", "SELECT label, count(*) AS n FROM labelled_pred GROUP BY label"))
def a12(spark, sf):
    return monitor.prediction_counts(views.pred(spark, sf))


@query("a14_confidence_histogram", with_("pred", """
SELECT le, n, round(total, 4) AS total, observations FROM (
  SELECT b.le, count(*) FILTER (confidence <= b.bound) AS n FROM pred, (VALUES ('0.1', 0.1::DOUBLE), ('0.3', 0.3),
    ('0.5', 0.5), ('0.7', 0.7), ('0.9', 0.9), ('1.0', 1.0), ('+Inf', 'inf'::DOUBLE)) AS b(le, bound) GROUP BY b.le),
  (SELECT sum(confidence) AS total, count(*) AS observations FROM pred)"""))
def a14(spark, sf):
    return monitor.confidence_histogram(views.pred(spark, sf)).withColumn("total", F.round("total", 4))


@query("a15_risk_counts", with_("labelled_pred", """
SELECT confidence_level, count(*) AS n FROM labelled_pred GROUP BY confidence_level"""))
def a15(spark, sf):
    return monitor.risk_counts(views.pred(spark, sf))


@query("l1_latest_n", with_("latest", "SELECT request_id, ts, prediction FROM latest"))
def l1(spark, sf):
    return monitor.latest_n(views.pred(spark, sf)).select("request_id", "ts", "prediction")


# --------------------------------------------------------------------- drift


@query("a4_class_shares", with_("live", """
SELECT true AS value, round(t, 9) AS share FROM live UNION ALL SELECT false, round(f, 9) FROM live"""))
def a4(spark, sf):
    latest = monitor.latest_n(views.pred(spark, sf))
    return drift.class_shares(latest, is_positive(F.col("prediction"))).select("value", *places(["share"], 9))


@query("a5_psi", with_(("base", "live"), """
SELECT round((l.t - b.t) * ln(l.t / b.t) + (l.f - b.f) * ln(l.f / b.f), 9) + 0.0 AS psi FROM base b, live l"""))
def a5(spark, sf):
    latest = monitor.latest_n(views.pred(spark, sf))
    live = drift.class_shares(latest, is_positive(F.col("prediction")))
    return drift.psi(drift.baseline_shares(baseline(spark, sf)), live).select(*places(["psi"], 9))


REPORT_SQL = with_(("base", "live"), """
SELECT CASE WHEN l.n >= 100 THEN 'success' ELSE 'skipped' END AS status,
  CASE WHEN l.n < 100 THEN 'insufficient_data' END AS reason, l.n AS count,
  round(CASE WHEN l.n >= 100 THEN b.t END, 9) AS training_true, round(CASE WHEN l.n >= 100 THEN b.f END, 9) AS training_false,
  round(CASE WHEN l.n >= 100 THEN l.t END, 9) AS latest_true, round(CASE WHEN l.n >= 100 THEN l.f END, 9) AS latest_false,
  round(CASE WHEN l.n >= 100 THEN (l.t - b.t) * ln(l.t / b.t) + (l.f - b.f) * ln(l.f / b.f) END, 9) + 0.0 AS psi
FROM base b, live l""")
REPORT_SHARES = ["training_true", "training_false", "latest_true", "latest_false", "psi"]


@query("a6_drift_report", REPORT_SQL)
def a6(spark, sf):
    report = drift.drift_report(baseline(spark, sf), views.telemetry(spark, sf))
    return report.select("status", "reason", "count", *places(REPORT_SHARES, 9))


@query("a6_drift_series", with_("psi_series", "SELECT request_id, ts, round(psi, 9) + 0.0 AS psi FROM psi_series"))
def a6_series(spark, sf):
    series = drift.drift_series(baseline(spark, sf), views.telemetry(spark, sf))
    return series.select("request_id", "ts", *places(["psi"], 9))


@query("a7_drift_severity", with_("psi_series", """
SELECT request_id, CASE WHEN psi * 10 > 0.2 THEN 'critical' WHEN psi * 10 > 0.1 THEN 'warning' ELSE 'none' END AS severity
FROM psi_series"""))
def a7(spark, sf):
    series = drift.drift_series(baseline(spark, sf), views.telemetry(spark, sf))
    return series.select("request_id", drift_severity(F.col("psi") * 10).alias("severity"))


# --------------------------------------------------------------------- rates

_WINDOW = "make_timestamp(w * 1000000) AS window_start, make_timestamp((w + 3600) * 1000000) AS window_end"


def _rates_sql(names, source, by=""):
    cols = f"{by}, " if by else ""
    return with_(names, f"""
SELECT {_WINDOW}, {cols}n, round(n / 3600.0::DOUBLE, 9) AS rate FROM windows""", windows=sliding(source, by))


def _rounded_rate(df):
    return df.withColumn("rate", F.round("rate", 9))


@query("w1_sliding_rate", _rates_sql("labelled_pred", "labelled_pred", "label"))
def w1(spark, sf):
    return _rounded_rate(rates.prediction_rate(views.pred(spark, sf), HOUR, QUARTER))


@query("w1_request_rate", _rates_sql("http_log", "http_log"))
def w1_requests(spark, sf):
    return _rounded_rate(rates.sliding_rate(views.http_log(spark, sf), HOUR, QUARTER))


@query("w1_risk_rate", _rates_sql("labelled_pred", "labelled_pred", "confidence_level"))
def w1_risk(spark, sf):
    return _rounded_rate(rates.risk_rate(views.pred(spark, sf), HOUR, QUARTER))


@query("w1_quality_rate", _rates_sql("issues", "issues", "quality_rule"))
def w1_quality(spark, sf):
    return _rounded_rate(rates.quality_rate(views.requests(spark, sf), HOUR, QUARTER))


@query("a17_prediction_split", with_("labelled_pred", f"""
SELECT {_WINDOW}, label, n, round(n / CAST(sum(n) OVER (PARTITION BY w) AS DOUBLE), 9) AS share FROM windows""",
    windows=sliding("labelled_pred", "label")))
def a17(spark, sf):
    split = rates.prediction_split(views.pred(spark, sf), HOUR, QUARTER)
    return split.withColumn("share", F.round("share", 9))


_ERRORS = "(SELECT * FROM http_log WHERE status NOT LIKE '2__') e"


@query("a18_http_errors_by_status", with_("http_log", """
SELECT make_timestamp(w * 1000000) AS window_start, make_timestamp((w + 300) * 1000000) AS window_end, status, n,
  round(n / 300.0::DOUBLE, 9) AS rate FROM windows""", windows=sliding(_ERRORS, "status", window=300, slide=15)))
def a18_by_status(spark, sf):
    """The last five minutes at every evaluation time."""
    return _rounded_rate(rates.http_error_rate(views.http_log(spark, sf), 300, config.EVALUATION_SECONDS, ["status"]))


@query("a18_http_error_rate", _rates_sql("http_log", _ERRORS, "job, instance"))
def a18(spark, sf):
    return _rounded_rate(rates.http_error_rate(views.http_log(spark, sf), HOUR, QUARTER))


# ------------------------------------------------------- held alert conditions


def rule(alert: str, threshold: float) -> config.AlertRule:
    """The rule of that name in the wider steps, with a limit the data can reach."""
    base = config.rule(alert)
    return dataclasses.replace(
        base, threshold=threshold, window=HOUR if base.window else None, hold=HOUR, step=QUARTER)


def _alert_sql(names, windows, by, used, extra=None, ticks=None, until=""):
    """States of a rule as SQL, from windows ``(w, *by, n)`` or ticks ``(k, *by, value)``."""
    cols = f"{by}, " if by else ""
    ticks = ticks or f"SELECT w // 900 + 4 AS k, {cols}n / 3600.0::DOUBLE AS value FROM windows"
    parts = dict(extra or {})
    if windows:
        parts["windows"] = windows
    parts["ticks"] = ticks
    parts["states"] = held("ticks", f"value {used.comparison} {used.threshold!r}::DOUBLE", by)
    return with_(names, f"""
SELECT tick, {cols}state, '{used.alert}' AS alert, '{used.severity}' AS severity FROM states {until}""", **parts)


def _gauge_sql(names, samples, by, used, tie="event_id", extra=None, until=""):
    return _alert_sql(names, None, by, used, extra, ticks=gauge(samples, by, tie), until=until)


X1 = rule("HttpNon200ResponseCode", 0.0)
X2 = rule("ApiRequestRateSpike", 5 / HOUR)
X3 = rule("HighMemoryUsage", 4e8)
X4 = rule("ModelLoadingFailure", 30.0)
X5 = rule("DataQualityIssuesDetected", 1.5 / HOUR)
X6 = rule("HighPSIDrift", 0.01)
X7 = rule("CriticalPSIDrift", 0.02)
X8 = rule("HighRansomwarePredictionRate", 4 / HOUR)
X9 = rule("LowCacheHitRate", 60.0)
X10 = rule("HighConfidenceRansomwareSpike", 1.5 / HOUR)

X1_SQL = _alert_sql("http_log", sliding(_ERRORS, "job, instance"), "job, instance", X1)
X8_TICKS = sliding("(SELECT * FROM labelled_pred WHERE label = 'ransomware') e", "label")


@query("w4_held_condition", with_("labelled_pred", """
SELECT tick, label, state FROM states""", windows=sliding("labelled_pred", "label"),
    ticks="SELECT w // 900 + 4 AS k, label, n / 3600.0::DOUBLE AS value FROM windows",
    states=held("ticks", "value > 5.5 / 3600.0::DOUBLE", "label")))
def w4(spark, sf):
    ticks = alerts.rate_ticks(rates.prediction_rate(views.pred(spark, sf), HOUR, QUARTER), ["label"])
    return alerts.held_condition(ticks, F.col("value") > 5.5 / 3600.0, ["label"], HOUR, QUARTER)


# Each metric's ticks, as the ten rules read them.


def _request_ticks(spark, sf):
    return alerts.rate_ticks(rates.sliding_rate(views.http_log(spark, sf), HOUR, QUARTER, X2.by), X2.by)


def _error_ticks(spark, sf):
    return alerts.rate_ticks(rates.http_error_rate(views.http_log(spark, sf), HOUR, QUARTER), X1.by)


def _gauge_ticks(spark, sf, factor):
    return alerts.gauge_ticks(views.gauges(spark, sf, factor), ["instance"], QUARTER, tie="event_id")


def _quality_ticks(spark, sf):
    return alerts.rate_ticks(rates.quality_rate(views.requests(spark, sf), HOUR, QUARTER), X5.by)


def _psi_ticks(spark, sf):
    series = drift.drift_series(baseline(spark, sf), views.telemetry(spark, sf))
    samples = series.select("request_id", "ts", F.lit(config.TARGET).alias("target"), F.col("psi").alias("value"))
    end = views.telemetry(spark, sf).agg(F.max("ts")).scalar()
    return alerts.gauge_ticks(samples, ["target"], QUARTER, tie="request_id", until=end)


def _prediction_ticks(spark, sf):
    return alerts.rate_ticks(rates.prediction_rate(views.pred(spark, sf), HOUR, QUARTER), X8.by)


def _hit_rate_ticks(spark, sf):
    marked = lookups.explain_lookup(views.lookups(spark, sf), views.pred(spark, sf))
    samples = lookups.running_hit_rate(marked).select("lookup_id", "ts", F.col("hit_rate").alias("value"))
    end = views.lookups(spark, sf).agg(F.max("ts")).scalar()
    return alerts.gauge_ticks(samples, (), QUARTER, tie="lookup_id", until=end)


def _risk_ticks(spark, sf):
    return alerts.rate_ticks(rates.risk_rate(views.pred(spark, sf), HOUR, QUARTER), X10.by)


_MEMORY = ("SELECT event_id, ts, concat('i', CAST(user_id % 3 AS VARCHAR)) AS instance, "
           "value * {factor}::DOUBLE AS value FROM events")
_PSI_SAMPLES = {"samples": "SELECT request_id, ts, 'is_ransomware' AS target, psi AS value FROM psi_series"}

X2_SQL = _alert_sql("http_log", sliding("http_log", "job, instance"), "job, instance", X2)
X3_SQL = _gauge_sql((), "samples", "instance", X3, extra={"samples": _MEMORY.format(factor="1e7")})
X4_SQL = _gauge_sql((), "samples", "instance", X4, extra={"samples": _MEMORY.format(factor="1.0")})
X5_SQL = _alert_sql("issues", sliding("issues", "quality_rule"), "quality_rule", X5)
X6_SQL = _gauge_sql("psi_series", "samples", "target", X6, "request_id", _PSI_SAMPLES)
X7_SQL = _gauge_sql("psi_series", "samples", "target", X7, "request_id", _PSI_SAMPLES)
X8_SQL = _alert_sql("labelled_pred", X8_TICKS, "label", X8)
RUNNING_SAMPLES = {"samples": "SELECT lookup_id, ts, hits * 100.0::DOUBLE / seen AS value FROM running"}
X9_SQL = _gauge_sql("running", "samples", "", X9, "lookup_id", RUNNING_SAMPLES)
X10_SQL = _alert_sql("labelled_pred", sliding(
    "(SELECT * FROM labelled_pred WHERE confidence_level = 'very high') e", "confidence_level"),
    "confidence_level", X10)


@query("x1_http_errors", X1_SQL)
def x1(spark, sf):
    return alerts.alerts(_error_ticks(spark, sf), X1)


@query("x2_request_spike", X2_SQL)
def x2(spark, sf):
    return alerts.alerts(_request_ticks(spark, sf), X2)


@query("x3_high_memory", X3_SQL)
def x3(spark, sf):
    return alerts.alerts(_gauge_ticks(spark, sf, 1e7), X3)


@query("x4_slow_model_load", X4_SQL)
def x4(spark, sf):
    return alerts.alerts(_gauge_ticks(spark, sf, 1.0), X4)


@query("x5_quality_issues", X5_SQL)
def x5(spark, sf):
    return alerts.alerts(_quality_ticks(spark, sf), X5)


@query("x6_high_drift", X6_SQL)
def x6(spark, sf):
    return alerts.alerts(_psi_ticks(spark, sf), X6)


@query("x7_critical_drift", X7_SQL)
def x7(spark, sf):
    return alerts.alerts(_psi_ticks(spark, sf), X7)


@query("x8_positive_rate", X8_SQL)
def x8(spark, sf):
    return alerts.alerts(_prediction_ticks(spark, sf), X8)


@query("x9_low_hit_rate", X9_SQL)
def x9(spark, sf):
    return alerts.alerts(_hit_rate_ticks(spark, sf), X9)


@query("x10_very_high_spike", X10_SQL)
def x10(spark, sf):
    return alerts.alerts(_risk_ticks(spark, sf), X10)


RULES = [X1, X2, X3, X4, X5, X6, X7, X8, X9, X10]
_ALL_SQL = " UNION ALL ".join(
    f"SELECT tick, alert, state FROM ({sql})"
    for sql in (X1_SQL, X2_SQL, X3_SQL, X4_SQL, X5_SQL, X6_SQL, X7_SQL, X8_SQL, X9_SQL, X10_SQL))


def all_states(spark, sf):
    """States of all ten rules over their metrics."""
    return monitoring.alert_states({
        "http_errors": _error_ticks(spark, sf), "http_requests": _request_ticks(spark, sf),
        "memory_usage_bytes": _gauge_ticks(spark, sf, 1e7), "model_load_seconds": _gauge_ticks(spark, sf, 1.0),
        "data_quality": _quality_ticks(spark, sf), "psi": _psi_ticks(spark, sf),
        "predictions": _prediction_ticks(spark, sf), "hit_rate": _hit_rate_ticks(spark, sf),
        "risk_levels": _risk_ticks(spark, sf),
    }, RULES)


@query("a19_alert_states", f"SELECT alert, state, count(*) AS n FROM ({_ALL_SQL}) GROUP BY ALL")
def a19_states(spark, sf):
    return all_states(spark, sf).groupBy("alert", "state").agg(F.count(F.lit(1)).alias("n"))


@query("a19_active_alerts", f"SELECT tick, count(*) AS n FROM ({_ALL_SQL}) WHERE state = 'firing' GROUP BY tick")
def a19(spark, sf):
    return alerts.active_alerts(all_states(spark, sf))
