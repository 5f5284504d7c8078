"""Streams, run over everything that is there and then read back.

A stream in append mode holds back what a late event could still change, so the
comparison SQL of the windowed queries stops at the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from addrwatch import config, views
from addrwatch.catalog.fixed_model import FIXED
from addrwatch.catalog.monitoring_queries import (
    HOUR, QUARTER, REPORT_SHARES, REPORT_SQL, RUNNING_SAMPLES, X3, X8, X8_TICKS, X9, _alert_sql, _ERRORS, _gauge_sql, _MEMORY,
    _rates_sql, baseline,
)
from addrwatch.catalog.registry import places, query
from addrwatch.catalog.scoring_queries import SERVED_SQL, fitted_stats, served_columns
from addrwatch.catalog.sql import with_
from addrwatch.functions.labels import label_name
from addrwatch.session import scratch_dir
from addrwatch.sources import tables
from addrwatch.streaming import drift, lookups, scoring, windows

DELAY = "1 hour"
_CLOSED = "WHERE {end} <= (SELECT max(ts) - INTERVAL 1 HOUR FROM {source})"


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream."""
    return spark.readStream.schema(views.SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf)


def drained(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run the stream over all input into a table and read that."""
    out = scratch_dir(spark, name)
    running = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _plain(df: DataFrame, *names: str) -> DataFrame:
    """Instants back to wall-clock times, as in the batch queries."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _request_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "requests")
    views.requests(spark, sf).write.json(path)
    return tables.read_requests(spark, path, streaming=True)


@query("t1_score_stream", SERVED_SQL)
def t1(spark, sf):
    scored = scoring.score_stream(_request_stream(spark, sf), fitted_stats(spark, sf), FIXED)
    return served_columns(drained(scored, spark, "scored"))


@query("t1_rejected_stream", with_("requests", """
SELECT request_id, concat_ws(',', CASE WHEN length IS NULL THEN 'length' END,
  CASE WHEN neighbors IS NULL THEN 'neighbors' END) AS missing
FROM requests WHERE length IS NULL OR neighbors IS NULL"""))
def t1_rejected(spark, sf):
    rejected = drained(scoring.rejected_stream(_request_stream(spark, sf)), spark, "rejected")
    return rejected.select("request_id", F.concat_ws(",", "missing_fields").alias("missing"))


@query("t2_telemetry_stream", with_("pred", 'SELECT ts AS "timestamp", prediction = 1 AS is_ransomware, confidence FROM pred'))
def t2(spark, sf):
    predictions = views.predictions_of(event_stream(spark, sf))
    return drained(scoring.telemetry_stream(predictions), spark, "telemetry")


@query("s7_append_telemetry", with_("pred", 'SELECT ts AS "timestamp", prediction = 1 AS is_ransomware, confidence FROM pred'))
def s7(spark, sf):
    out = scratch_dir(spark, "telemetry")
    records = scoring.telemetry_stream(views.predictions_of(event_stream(spark, sf)))
    tables.append_telemetry(records, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return tables.read_telemetry(spark, f"{out}/rows")


def _stream_rates(names, source, by, inner=None):
    sql = _rates_sql(names, inner or source, by)
    return f"{sql} {_CLOSED.format(end='make_timestamp((w + 3600) * 1000000)', source=source)}"


def _rated(stream, spark, name):
    out = drained(stream, spark, name).withColumn("rate", F.round("rate", 9))
    return _plain(out, "window_start", "window_end")


@query("t3_prediction_rate", _stream_rates("labelled_pred", "labelled_pred", "label"))
def t3_predictions(spark, sf):
    predictions = views.predictions_of(event_stream(spark, sf))
    return _rated(windows.prediction_stream_rate(predictions, HOUR, QUARTER, DELAY), spark, "rates")


@query("t3_risk_rate", _stream_rates("labelled_pred", "labelled_pred", "confidence_level"))
def t3_risk(spark, sf):
    predictions = views.predictions_of(event_stream(spark, sf))
    return _rated(windows.risk_stream_rate(predictions, HOUR, QUARTER, DELAY), spark, "rates")


@query("t3_quality_rate", _stream_rates("issues", "requests", "quality_rule", "issues"))
def t3_quality(spark, sf):
    return _rated(windows.quality_stream_rate(_request_stream(spark, sf), HOUR, QUARTER, DELAY), spark, "rates")


def _log_stream(spark, sf):
    return views.http_log_of(event_stream(spark, sf))


@query("t3_http_error_rate", _stream_rates("http_log", "http_log", "job, instance", _ERRORS))
def t3_errors(spark, sf):
    return _rated(windows.http_error_stream_rate(_log_stream(spark, sf), HOUR, QUARTER, DELAY), spark, "rates")


@query("t4_alert_stream", _alert_sql(
    "labelled_pred", X8_TICKS, "label", X8, until=_CLOSED.format(end="tick", source="labelled_pred")))
def t4(spark, sf):
    named = views.predictions_of(event_stream(spark, sf)).withColumn("label", label_name(F.col("prediction")))
    states = windows.alert_stream(named, X8, DELAY)
    return _plain(drained(states, spark, "alerts"), "tick")


# No gap between the given samples is longer.
STALE = 86_400


@query("t4_gauge_alert_stream", _gauge_sql(
    (), "samples", "instance", X3, extra={"samples": _MEMORY.format(factor="1e7")}, until=_CLOSED.format(end="tick", source="samples")))
def t4_gauge(spark, sf):
    samples = views.gauges_of(event_stream(spark, sf), 1e7)
    states = windows.gauge_alert_stream(samples, X3, DELAY, stale=STALE, tie="event_id")
    return _plain(drained(states, spark, "alerts"), "tick")


@query("t5_drift_stream", REPORT_SQL)
def t5(spark, sf):
    out = scratch_dir(spark, "drift")
    predictions = views.predictions_of(event_stream(spark, sf))
    records = predictions.withColumn(config.TARGET, F.col("prediction") == 1)
    drift.drift_stream(records, baseline(spark, sf), out, period=None).awaitTermination()
    reports = spark.read.parquet(f"{out}/reports")
    return reports.select("status", "reason", "count", *places(REPORT_SHARES, 9))


@query("t6_explain_stream", with_("marked", "SELECT lookup_id, ts, request_id, hit FROM marked"))
def t6(spark, sf):
    events = event_stream(spark, sf)
    served = lookups.explain_stream(views.lookups_of(events), views.predictions_of(events))
    return drained(served, spark, "lookups").select("lookup_id", "ts", "request_id", "hit")


@query("x9_low_hit_rate_stream", _gauge_sql(
    "running", "samples", "", X9, "lookup_id", RUNNING_SAMPLES, until=_CLOSED.format(end="tick", source="samples")))
def x9_stream(spark, sf):
    events = event_stream(spark, sf)
    served = lookups.explain_stream(views.lookups_of(events), views.predictions_of(events))
    states = windows.hit_rate_alert_stream(served, X9, DELAY, stale=STALE)
    return _plain(drained(states, spark, "alerts"), "tick")
