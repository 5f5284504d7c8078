"""Scoring of requests and explanation of predictions, for tables and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from addrwatch import config
from addrwatch.functions import dates, labels
from addrwatch.operators import additive, evaluate, features, lookups as lookup_ops, requests as checks
from addrwatch.operators.runs import best_run
from addrwatch.operators.stats import Stats
from addrwatch.sources import tables


def score(requests: DataFrame, stats: Stats, model: additive.AdditiveModel) -> DataFrame:
    """Prediction records of the complete requests.

    Negative values are noted in ``quality_rules`` and scored all the same.
    """
    flagged = checks.negative_flags(checks.valid_requests(requests))
    scored = additive.predict(features.transform(flagged, stats), model)
    return scored.select(
        "request_id", "ts", "prediction",
        labels.label_name(F.col("prediction")).alias("label"),
        F.col("probability").alias("confidence"),
        labels.risk_level(F.col("prediction"), F.col("probability")).alias("confidence_level"),
        "quality_rules",
    )


def with_request_id(requests: DataFrame) -> DataFrame:
    """Give an id to requests that came without one."""
    return requests.withColumn("request_id", F.coalesce(F.col("request_id"), labels.request_id()))


def telemetry(predictions: DataFrame) -> DataFrame:
    """``(timestamp, is_ransomware, confidence)`` per prediction."""
    return predictions.select(
        F.col("ts").alias("timestamp"),
        labels.is_positive(F.col("prediction")).alias(config.TARGET),
        "confidence",
    )


def telemetry_text(records: DataFrame) -> DataFrame:
    """The same with the time as ISO text at the fixed offset."""
    return records.withColumn("timestamp", dates.telemetry_time(F.col("timestamp")))


def serve_batch(spark: SparkSession, requests: DataFrame, out: str) -> DataFrame:
    """Score with model and statistics of the best finished run below ``out``."""
    chosen = best_run(tables.read_runs(spark, f"{out}/runs")).first()
    if chosen is None:
        raise RuntimeError("A model that was not trained has no scores.")
    path = f"{out}/models/{chosen['run_id']}"
    return score(requests, tables.load_stats(spark, f"{path}/stats"), tables.load_model(spark, path))


def explain_request(
    lookups: DataFrame,
    predictions: DataFrame,
    raw_features: DataFrame,
    stats: Stats,
    model: additive.AdditiveModel,
    k: int = config.TOP_TERMS,
) -> DataFrame:
    """``(lookup_id, request_id, rank, term, value)``: the k strongest terms of each
    successful look-up, signs kept.

    A request is explained at most once, so its features meet one look-up at most.
    """
    hits = lookup_ops.explain_lookup(lookups, predictions).filter("hit").select("lookup_id", "request_id")
    asked = hits.join(raw_features, "request_id")
    explained = additive.term_scores(features.transform(asked, stats), model)
    wide = explained.select(
        "lookup_id", "request_id", *[F.col("terms")[n].alias(n) for n in model.term_names]
    )
    top = evaluate.top_terms_abs(wide, model.term_names, k)
    # Never empty; the outer form only keeps Spark from testing that by scoring twice.
    ranked = F.posexplode_outer("top_terms").alias("rank", "top")
    return top.select("lookup_id", "request_id", ranked).select(
        "lookup_id", "request_id", (F.col("rank") + 1).alias("rank"), "top.term", "top.value"
    )
