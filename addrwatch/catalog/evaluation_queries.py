"""Scores against labels: curve, threshold, confusion counts, attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from addrwatch import views
from addrwatch.catalog.fixed_model import FIXED
from addrwatch.catalog.registry import places, query
from addrwatch.catalog.sql import TERM_NAMES, terms, with_
from addrwatch.functions import labels
from addrwatch.operators import additive, evaluate, features
from addrwatch.operators.stats import fit_stats


@query("p10_apply_threshold", with_("pred", "SELECT request_id, CAST(confidence >= 0.7 AS INTEGER) AS prediction FROM pred"))
def p10(spark, sf):
    return views.pred(spark, sf).select(
        "request_id", labels.apply_threshold(F.col("confidence"), 0.7).alias("prediction"))


_OUTCOME = """CASE WHEN y = 1 AND {p} THEN 'tp' WHEN y = 1 THEN 'fn' WHEN {p} THEN 'fp' ELSE 'tn' END"""


@query("p11_outcome_class", with_("pred", f"""
SELECT request_id, {_OUTCOME.format(p='prediction = 1')} AS outcome FROM pred"""))
def p11(spark, sf):
    return evaluate.with_outcome(views.pred(spark, sf), "y").select("request_id", "outcome")


@query("a8_evaluate", with_("pred", """
SELECT round(avg(CAST(y = CAST(confidence >= 0.6 AS INTEGER) AS DOUBLE)), 9) AS accuracy,
  count(*) FILTER (y = 1 AND confidence >= 0.6) AS tp, count(*) FILTER (y = 1 AND confidence < 0.6) AS fn,
  count(*) FILTER (y = 0 AND confidence >= 0.6) AS fp, count(*) FILTER (y = 0 AND confidence < 0.6) AS tn
FROM pred"""))
def a8(spark, sf):
    return evaluate.evaluate(views.pred(spark, sf), 0.6, "y", "confidence").withColumn(
        "accuracy", F.round("accuracy", 9))


_CURVE = """
SELECT threshold, tp, fp, tp / CAST((SELECT sum(y) FROM pred) AS DOUBLE) AS tpr,
  fp / CAST((SELECT sum(1 - y) FROM pred) AS DOUBLE) AS fpr
FROM (SELECT threshold, CAST(sum(pos) OVER o AS BIGINT) AS tp, CAST(sum(neg) OVER o AS BIGINT) AS fp
  FROM (SELECT confidence AS threshold, sum(y) AS pos, sum(1 - y) AS neg FROM pred GROUP BY confidence)
  WINDOW o AS (ORDER BY threshold DESC))"""


@query("w2_cumulative_tpr_fpr", with_("pred", """
SELECT threshold, tp, fp, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr FROM curve""", curve=_CURVE))
def w2(spark, sf):
    curve = evaluate.cumulative_tpr_fpr(views.pred(spark, sf), "y", "confidence")
    return curve.select("threshold", "tp", "fp", *places(["tpr", "fpr"], 9))


@query("a9_roc_curve", with_("pred", """
SELECT threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM curve
UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0""", curve=_CURVE))
def a9(spark, sf):
    curve = evaluate.roc_curve(views.pred(spark, sf), "y", "confidence")
    return curve.select("threshold", *places(["fpr", "tpr"], 9))


@query("a10_best_threshold", with_("pred", """
SELECT threshold, j FROM (SELECT threshold, round(tpr - fpr, 9) AS j FROM curve UNION ALL SELECT 'inf'::DOUBLE, 0.0)
ORDER BY j DESC, threshold DESC LIMIT 1""", curve=_CURVE))
def a10(spark, sf):
    return evaluate.best_threshold(views.pred(spark, sf), "y", "confidence")


def _scored(spark, sf):
    """Activity with term values and outcome, as wide columns."""
    passed = features.first_pass(views.labelled(spark, sf))
    scored = additive.predict(features.second_pass(passed, fit_stats(passed)), FIXED)
    flat = scored.select(
        "address", "is_ransomware", "probability", "prediction",
        *[F.col("terms")[n].alias(n) for n in FIXED.term_names])
    return evaluate.with_outcome(flat)


_SUMMED = """
SELECT id, any_value(y) AS y, 1 / (1 + exp(-(-0.21 + sum(value)))) AS p
FROM term_rows JOIN (SELECT address, is_ransomware AS y FROM prep) ON address = id GROUP BY id"""
_CLASSED = f"SELECT id, {_OUTCOME.format(p='p >= 0.57')} AS outcome FROM summed"
_MEANS = """
SELECT outcome, term, avg(value) AS mean_value FROM term_rows JOIN classed USING (id)
WHERE outcome IN ('tp', 'fn') GROUP BY outcome, term"""
_CHAIN = {"term_rows": terms("scorable"), "summed": _SUMMED, "classed": _CLASSED, "means": _MEANS}


@query("a11_mean_attribution", with_(("scorable", "bins", "gaps"), """
SELECT outcome, term, round(mean_value, 6) + 0.0 AS mean_value FROM means""", **_CHAIN))
def a11(spark, sf):
    means = evaluate.mean_attribution(_scored(spark, sf), TERM_NAMES)
    return means.select("outcome", "term", *places(["mean_value"]))


_RANKED = """
SELECT outcome, row_number() OVER (PARTITION BY outcome ORDER BY mean_value, term) AS rank, term,
  round(mean_value, 6) + 0.0 AS mean_value FROM means"""


@query("w5_rank_terms", with_(("scorable", "bins", "gaps"), f"""
SELECT outcome, CAST(rank AS INTEGER) AS rank, term, mean_value FROM ({_RANKED})""", **_CHAIN))
def w5(spark, sf):
    means = evaluate.mean_attribution(_scored(spark, sf), TERM_NAMES)
    ranked = evaluate.rank_terms(means, ["outcome"], [F.col("mean_value")])
    return ranked.select("outcome", "rank", "term", *places(["mean_value"]))


@query("l3_weakest_terms", with_(("scorable", "bins", "gaps"), f"""
SELECT outcome, CAST(rank AS INTEGER) AS rank, term, mean_value FROM ({_RANKED}) WHERE rank <= 5""", **_CHAIN))
def l3(spark, sf):
    weakest = evaluate.weakest_terms(_scored(spark, sf), TERM_NAMES)
    return weakest.select("outcome", "rank", "term", *places(["mean_value"]))


@query("l2_top_terms", with_(("scorable", "bins", "gaps"), """
SELECT id AS address, CAST(rank AS INTEGER) AS rank, term, value FROM (
  SELECT id, term, value, row_number() OVER (PARTITION BY id ORDER BY abs(value) DESC, term) AS rank
  FROM term_rows) WHERE rank <= 5""", term_rows=terms("scorable")))
def l2(spark, sf):
    top = evaluate.top_terms_abs(_scored(spark, sf), TERM_NAMES)
    return top.select("address", F.posexplode_outer("top_terms").alias("rank", "top")).select(
        "address", (F.col("rank") + 1).alias("rank"), "top.term", "top.value")
