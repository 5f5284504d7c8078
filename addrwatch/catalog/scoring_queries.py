"""Requests, predictions, look-ups, explanations, models and runs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from addrwatch import config, views
from addrwatch.catalog.fixed_model import FIXED
from addrwatch.catalog.registry import query
from addrwatch.catalog.sql import terms, with_
from addrwatch.functions import dates, labels, numeric
from addrwatch.operators import additive, evaluate, features, lookups, requests as checks, runs
from addrwatch.operators.prep import split_data
from addrwatch.operators.stats import fit_stats
from addrwatch.plans import serving, training
from addrwatch.session import scratch_dir
from addrwatch.sources import activity, tables

RAW = ", ".join(config.RAW_FEATURES)
# The given orders are older than the default start date.
FIRST_DAY = date(1990, 1, 1)


def fitted_stats(spark, sf):
    return fit_stats(features.first_pass(views.labelled(spark, sf)))


def second_pass(spark, sf):
    passed = features.first_pass(views.labelled(spark, sf))
    return features.second_pass(passed, fit_stats(passed))


# ----------------------------------------------------------------- requests


@query("s6_read_requests", with_("requests", f"SELECT request_id, ts, {RAW} FROM requests"))
def s6(spark, sf):
    path = scratch_dir(spark, "requests")
    views.requests(spark, sf).write.json(path)
    return tables.read_requests(spark, path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_MISSING = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in config.RAW_FEATURES) + ")"


@query("p8_required_fields", with_("requests", f"""
SELECT request_id, {_MISSING} AS missing, {_MISSING} = '' AS valid FROM requests"""))
def p8(spark, sf):
    checked = checks.required_fields(views.requests(spark, sf))
    return checked.select(
        "request_id", F.concat_ws(",", "missing_fields").alias("missing"), checks.is_complete().alias("valid"))


@query("p9_negative_flags", with_("issues", "SELECT request_id, quality_rule FROM issues"))
def p9(spark, sf):
    return checks.quality_issues(views.requests(spark, sf)).select("request_id", "quality_rule")


@query("a13_quality_counts", with_("issues", """
SELECT quality_rule, count(*) AS n FROM issues GROUP BY quality_rule"""))
def a13(spark, sf):
    return checks.quality_counts(views.requests(spark, sf))


# ---------------------------------------------------------- scalar functions


@query("f7_probability", with_("pred", """
SELECT request_id, round(1 / (1 + exp(-(4 * confidence - 2))), 9) AS p FROM pred"""))
def f7(spark, sf):
    raw = 4 * F.col("confidence") - 2
    return views.pred(spark, sf).select("request_id", F.round(numeric.probability(raw), 9).alias("p"))


@query("f8_label_name", with_("labelled_pred", "SELECT request_id, label FROM labelled_pred"))
def f8(spark, sf):
    return views.pred(spark, sf).select("request_id", labels.label_name(F.col("prediction")).alias("label"))


@query("f9_risk_level", with_("labelled_pred", "SELECT request_id, confidence_level FROM labelled_pred"))
def f9(spark, sf):
    return views.pred(spark, sf).select(
        "request_id", labels.risk_level(F.col("prediction"), F.col("confidence")).alias("confidence_level"))


@query("f10_request_id", with_("requests", """
SELECT count(*) AS n, count(DISTINCT request_id) AS ids, 36 AS shortest FROM requests"""))
def f10(spark, sf):
    # No id of its own: every request draws a new one.
    unnamed = views.requests(spark, sf).withColumn("request_id", F.lit(None).cast("string"))
    return serving.with_request_id(unnamed).agg(
        F.count("request_id").alias("n"), F.count_distinct("request_id").alias("ids"),
        F.min(F.length("request_id")).alias("shortest"))


@query("f11_telemetry_time", with_("pred", """
SELECT request_id, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+01:00' AS "timestamp" FROM pred"""))
def f11(spark, sf):
    return views.pred(spark, sf).select("request_id", dates.telemetry_time(F.col("ts")).alias("timestamp"))


@query("f12_is_positive", with_("pred", "SELECT request_id, prediction = 1 AS is_ransomware FROM pred"))
def f12(spark, sf):
    return views.pred(spark, sf).select(
        "request_id", labels.is_positive(F.col("prediction")).alias("is_ransomware"))


# ------------------------------------------------------------------ look-ups


@query("j1_explain_lookup", with_("marked", "SELECT lookup_id, ts, request_id, hit FROM marked"))
def j1(spark, sf):
    return lookups.explain_lookup(views.lookups(spark, sf), views.pred(spark, sf)).select(
        "lookup_id", "ts", "request_id", "hit")


@query("j2_lookup_misses", with_(("lookups", "pred"), """
SELECT lookup_id, ts, request_id FROM lookups WHERE request_id NOT IN (SELECT request_id FROM pred)"""))
def j2(spark, sf):
    return lookups.lookup_misses(views.lookups(spark, sf), views.pred(spark, sf)).select(
        "lookup_id", "ts", "request_id")


@query("a16_lookup_hit_rate", with_("marked", """
SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses,
  round(count(*) FILTER (hit) * 100.0::DOUBLE / count(*), 6) AS hit_rate FROM marked"""))
def a16(spark, sf):
    marked = lookups.explain_lookup(views.lookups(spark, sf), views.pred(spark, sf))
    return lookups.lookup_hit_rate(marked).withColumn("hit_rate", F.round("hit_rate", 6))


@query("w3_running_hit_rate", with_("running", """
SELECT lookup_id, hits, seen, round(hits * 100.0::DOUBLE / seen, 6) AS hit_rate FROM running"""))
def w3(spark, sf):
    marked = lookups.explain_lookup(views.lookups(spark, sf), views.pred(spark, sf))
    return lookups.running_hit_rate(marked).select(
        "lookup_id", "hits", "seen", F.round("hit_rate", 6).alias("hit_rate"))


# -------------------------------------------------------------------- models


@query("m2_term_scores", with_(("scorable", "bins", "gaps"), """
SELECT id AS address, term, value FROM term_rows""", term_rows=terms("scorable")))
def m2(spark, sf):
    scored = additive.term_scores(second_pass(spark, sf), FIXED)
    return scored.select(
        "address", F.explode_outer(additive.attribution_map(FIXED)).alias("term", "value"))


_TOTAL = "SELECT id, 1 / (1 + exp(-(-0.21 + sum(value)))) AS p FROM term_rows GROUP BY id"
_SCORED = {"term_rows": terms("scorable"), "scored": _TOTAL}


@query("m3_explain", with_(("scorable", "bins", "gaps"), """
SELECT id AS address, round(p, 9) AS probability, value AS strongest FROM scored JOIN (
  SELECT id, value FROM term_rows QUALIFY row_number() OVER (PARTITION BY id ORDER BY abs(value) DESC, term) = 1
) USING (id)""", **_SCORED))
def m3(spark, sf):
    explained = additive.explain(second_pass(spark, sf), FIXED)
    largest = F.array_sort(F.transform(
        F.map_entries(additive.attribution_map(FIXED)),
        lambda e: F.struct((-F.abs(e["value"])).alias("size"), e["key"].alias("term"), e["value"].alias("value"))))
    return explained.select(
        "address", F.round("probability", 9).alias("probability"), largest[0]["value"].alias("strongest"))


@query("m4_predict", with_(("scorable", "bins", "gaps"), """
SELECT id AS address, CAST(p >= 0.57 AS INTEGER) AS prediction FROM scored""", **_SCORED))
def m4(spark, sf):
    return additive.predict(second_pass(spark, sf), FIXED).select("address", "prediction")


@query("s11_model", with_(("scorable", "bins", "gaps"), """
SELECT id AS address, round(p, 9) AS probability FROM scored""", **_SCORED))
def s11(spark, sf):
    path = scratch_dir(spark, "model")
    tables.save_model(spark, FIXED, path)
    model = tables.load_model(spark, path)
    return additive.explain(second_pass(spark, sf), model).select(
        "address", F.round("probability", 9).alias("probability"))


_ASKED_FEATURES = """SELECT s.*, m.lookup_id, m.lookup_id AS id, m.request_id
FROM marked m JOIN second_pass s ON s.address = CAST(m.request_id AS VARCHAR) WHERE m.hit"""


@query("m5_explain_request", with_(("marked", "second_pass", "bins", "gaps"), """
SELECT lookup_id, request_id, CAST(rank AS INTEGER) AS rank, term, value FROM (
  SELECT t.id AS lookup_id, a.request_id, term, value,
    row_number() OVER (PARTITION BY t.id ORDER BY abs(value) DESC, term) AS rank
  FROM term_rows t JOIN asked a ON a.id = t.id) WHERE rank <= 5""",
    asked=_ASKED_FEATURES, term_rows=terms("asked")))
def m5(spark, sf):
    raw = views.tx(spark, sf).select(F.col("address").cast("bigint").alias("request_id"), *config.RAW_FEATURES)
    return serving.explain_request(
        views.lookups(spark, sf), views.pred(spark, sf), raw, fitted_stats(spark, sf), FIXED)


def _split_table(spark, sf, weight=None):
    """Second-pass rows of the training split, stored once for the optimiser."""
    work = scratch_dir(spark, "train")
    rows = split_data(second_pass(spark, sf)).filter(F.col("split") == "train").drop("split")
    rows.withColumn("weight", F.col("weight") if weight is None else weight).write.parquet(work)
    return spark.read.parquet(work)


def _fit_summary(rows, model):
    """Rows, positives, terms, and whether the mean score is the share of positives,
    over all rows and over those without a weight."""
    gap = F.abs(F.avg("probability") - F.avg(config.TARGET))
    bare = F.col("weight").isNull()
    without = F.abs(F.avg(F.when(bare, F.col("probability"))) - F.avg(F.when(bare, F.col(config.TARGET))))
    return additive.explain(rows, model).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(config.TARGET).cast("bigint")).alias("positives"),
        F.lit(len(model.terms)).alias("terms"), F.count_if(bare).alias("without_weight"),
        (gap < 0.005).alias("calibrated"), (F.coalesce(without, F.lit(0.0)) < 0.005).alias("calibrated_without_weight"))


def _fit_sql(terms_, without):
    return with_("sampled", f"""
SELECT count(*) AS n, CAST(sum(is_ransomware) AS BIGINT) AS positives, {terms_} AS terms, {without} AS without_weight,
  true AS calibrated, true AS calibrated_without_weight FROM sampled WHERE split = 'train'""")


@query("m1_fit_additive", _fit_sql(16, "CAST(0 AS BIGINT)"))
def m1(spark, sf):
    train = _split_table(spark, sf)
    return _fit_summary(train, additive.fit_additive(train, features.SECOND_PASS_COLS))


@query("m6_pair_terms", _fit_sql(18, "count(*) FILTER (CAST(address AS BIGINT) % 10 = 0)"))
def m6(spark, sf):
    """Two pairs of the trainer's choice; every tenth address has no weight."""
    train = _split_table(spark, sf, F.when(F.col("address").cast("bigint") % 10 != 0, F.col("weight")))
    names = features.SECOND_PASS_COLS
    pairs = additive.strongest_pairs(train, additive.fit_additive(train, names), names, 1)
    pairs = list(dict.fromkeys([*pairs, ("length", "weight"), ("log_income", "weight")]))[:2]
    return _fit_summary(train, additive.fit_additive(train, names, pairs=pairs))


# ---------------------------------------------------------------------- runs


@query("p12_finished_runs", with_("runs", """
SELECT run_id, run_name, fn FROM runs WHERE status = 'FINISHED' AND run_name LIKE '%feature_eng_2'"""))
def p12(spark, sf):
    return runs.finished_runs(views.runs(spark, sf)).select("run_id", "run_name", F.col("metrics")["fn"].alias("fn"))


@query("l4_best_run", with_("runs", """
SELECT run_id, fn FROM runs WHERE status = 'FINISHED' AND run_name LIKE '%feature_eng_2'
ORDER BY fn, start_ts DESC, run_id LIMIT 1"""))
def l4(spark, sf):
    return runs.best_run(views.runs(spark, sf)).select("run_id", F.col("metrics")["fn"].alias("fn"))


def _stored_activity(spark, sf):
    path = scratch_dir(spark, "activity")
    activity.write_activity(views.tx(spark, sf), path)
    return path




def _judged(metrics):
    """Test rows of each class, which the split fixes, and whether the accuracy adds up."""
    n = F.col("tp") + F.col("fn") + F.col("fp") + F.col("tn")
    return metrics.select(
        "run_name", (F.col("tp") + F.col("fn")).cast("bigint").alias("positives"),
        (F.col("fp") + F.col("tn")).cast("bigint").alias("negatives"),
        (F.abs(F.col("accuracy") - (F.col("tp") + F.col("tn")) / n) < 1e-9).alias("accuracy_adds_up"))


def _judged_sql(names):
    return with_("sampled", f"""
SELECT 'addrwatch_' || s AS run_name, count(*) FILTER (is_ransomware = 1) AS positives,
  count(*) FILTER (is_ransomware = 0) AS negatives, true AS accuracy_adds_up
FROM sampled, (VALUES {', '.join(f"('{n}')" for n in names)}) v(s) WHERE split = 'test' GROUP BY s""")


@query("c5_train_and_evaluate", _judged_sql(["feature_eng_2"]))
def c5(spark, sf):
    out = scratch_dir(spark, "training")
    stage = tables.write_stage(features.transform(views.labelled(spark, sf)), f"{out}/stage")
    training.train_and_evaluate(spark, stage, "feature_eng_2", out)
    return _judged(training.stage_metrics(tables.read_runs(spark, f"{out}/runs")))


@query("s12_log_run", with_("pred", """
SELECT 'r1' AS run_id, 'addrwatch_baseline' AS run_name, 'FINISHED' AS status, metric, CAST(value AS DOUBLE) AS value FROM (
  SELECT count(*) FILTER (y = 1 AND prediction = 1) AS tp, count(*) FILTER (y = 1 AND prediction = 0) AS fn,
    count(*) FILTER (y = 0 AND prediction = 1) AS fp, count(*) FILTER (y = 0 AND prediction = 0) AS tn FROM pred)
UNPIVOT (value FOR metric IN (tp, fn, fp, tn))"""))
def s12(spark, sf):
    """A run logged with the counts of the given predictions, read back."""
    path = scratch_dir(spark, "runs")
    found = evaluate.evaluate(views.pred(spark, sf), 0.5, y="y", score="confidence").drop("accuracy").first().asDict()
    tables.log_run(spark, path, "r1", "addrwatch_baseline", {"data_path": sf}, found)
    return tables.read_runs(spark, path).select(
        "run_id", "run_name", "status", F.explode("metrics").alias("metric", "value"))


@query("c6_compare_stages", _judged_sql(["baseline", "feature_eng_1", "feature_eng_2"]))
def c6(spark, sf):
    out = scratch_dir(spark, "training")
    return _judged(training.compare_stages(spark, _stored_activity(spark, sf), out, FIRST_DAY))


_SERVED = """
SELECT t.id AS request_id, 1 / (1 + exp(-(-0.21 + sum(t.value)))) AS p FROM term_rows t GROUP BY t.id"""
SERVED_SQL = with_(("request_second", "bins", "gaps"), """
SELECT request_id, ts, CAST(p >= 0.57 AS INTEGER) AS prediction,
  CASE WHEN p >= 0.57 THEN 'ransomware' ELSE 'white' END AS label, round(p, 9) AS confidence,
  CASE WHEN p < 0.57 THEN 'low' WHEN p >= 0.9 THEN 'very high' WHEN p >= 0.7 THEN 'high' ELSE 'medium' END AS confidence_level,
  concat_ws(',', CASE WHEN v.length < 0 THEN 'neg_length' END, CASE WHEN v.weight < 0 THEN 'neg_weight' END,
    CASE WHEN v.count < 0 THEN 'neg_count' END, CASE WHEN v.looped < 0 THEN 'neg_looped' END,
    CASE WHEN v.neighbors < 0 THEN 'neg_neighbors' END, CASE WHEN v.income < 0 THEN 'neg_income' END) AS quality_rules
FROM served JOIN valid v USING (request_id)""", term_rows=terms("request_second"), served=_SERVED)


def served_columns(predictions):
    return predictions.select(
        "request_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "prediction", "label",
        F.round("confidence", 9).alias("confidence"), "confidence_level",
        F.concat_ws(",", "quality_rules").alias("quality_rules"))


@query("c7_serve_batch", SERVED_SQL)
def c7(spark, sf):
    """The older run is the better one; the newer one's statistics must not be used."""
    out = scratch_dir(spark, "serving")
    stats = fitted_stats(spark, sf)
    for run_id, fn, shift in (("older", 1.0, 0.0), ("newer", 5.0, 1.0)):
        tables.save_model(spark, FIXED, f"{out}/models/{run_id}")
        tables.save_stats(stats.withColumn("mean", F.col("mean") + shift), f"{out}/models/{run_id}/stats")
        tables.log_run(spark, f"{out}/runs", run_id, "addrwatch_feature_eng_2", {}, {"fn": fn})
    return served_columns(serving.serve_batch(spark, views.requests(spark, sf), out))
