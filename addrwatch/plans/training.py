"""Training, evaluation and comparison of the stages."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from addrwatch import config
from addrwatch.operators import additive, evaluate, prep
from addrwatch.operators.stats import class_counts
from addrwatch.plans.prepare import build_stages
from addrwatch.session import drop_scratch, scratch_dir
from addrwatch.sources import tables


def model_features(df: DataFrame, target: str = config.TARGET) -> list[str]:
    aside = {*prep.SAMPLE_KEY, "split"}
    return [c for c in prep.feature_columns(df, target).columns if c not in aside]


@dataclass(frozen=True)
class Trained:
    """A fitted and evaluated stage, not yet saved."""

    suffix: str
    data_path: str
    split_path: str
    started: datetime
    model: additive.AdditiveModel
    feature_info: dict[str, dict[str, float]]
    metrics: dict[str, float | None]
    scores_path: str


def train(
    spark: SparkSession,
    data_path: str,
    suffix: str,
    bins: int = 16,
    pairs: Sequence[tuple[str, str]] = (),
    interactions: int = 0,
) -> Trained:
    """Split, fit, choose the threshold on the training rows, evaluate on the others.

    What reaches the driver is the model, the threshold, at most ten mean
    attributions and five counts. The split and the training scores are written
    down once, since fitting and the ROC curve read them again and again.
    ``interactions`` adds so many pair terms of the trainer's own choice to ``pairs``.
    """
    started = datetime.now()
    data = tables.read_stage(spark, data_path)
    features = model_features(data)
    split_path = scratch_dir(spark, f"split-{suffix}")
    split = prep.split_data(data, counts=class_counts(data.select(config.TARGET)))
    split.select(config.TARGET, "split", *features).write.partitionBy("split").parquet(split_path)
    train_rows, test_rows = (_part(spark, split_path, name) for name in ("train", "test"))

    model = additive.fit_additive(train_rows, features, bins=bins, pairs=pairs)
    if interactions:
        found = additive.strongest_pairs(train_rows, model, features, interactions)
        pairs = list(dict.fromkeys([*pairs, *found]))
        model = additive.fit_additive(train_rows, features, bins=bins, pairs=pairs)
    scores = scratch_dir(spark, f"scores-{suffix}")
    names = model.term_names
    additive.explain(train_rows, model).select(
        config.TARGET, "probability", *[F.col("terms")[n].alias(n) for n in names]
    ).write.parquet(scores)
    scored = spark.read.parquet(scores)
    threshold = evaluate.best_threshold(scored).first()["threshold"]
    classed = evaluate.with_outcome(evaluate.with_prediction(scored, threshold))
    info: dict[str, dict[str, float]] = {config.TP_WEAKEST: {}, config.FN_STRONGEST: {}}
    for r in evaluate.weakest_terms(classed, names).collect():
        info[config.TP_WEAKEST if r["outcome"] == "tp" else config.FN_STRONGEST][r["term"]] = r["mean_value"]
    metrics = evaluate.evaluate(additive.explain(test_rows, model), threshold).first().asDict()
    return Trained(suffix, data_path, split_path, started, model.with_threshold(threshold), info, metrics, scores)


def _part(spark: SparkSession, split_path: str, name: str) -> DataFrame:
    return spark.read.parquet(split_path).filter(F.col("split") == name).drop("split")


def record(
    spark: SparkSession, done: Trained, out: str, run_id: str | None = None, stats_path: str | None = None
) -> str:
    """Save baseline, model, statistics and run below ``out``; the baseline replaces the last one.

    The statistics that scaled the stage stay with the run, so that its model never
    meets those of another. Scratch tables of the training are deleted.
    """
    run_id = run_id or uuid.uuid4().hex
    tables.save_baseline(_part(spark, done.split_path, "train"), f"{out}/training_baseline", run_id)
    tables.save_model(spark, done.model, f"{out}/models/{run_id}")
    if stats_path:
        tables.save_stats(tables.load_stats(spark, stats_path), f"{out}/models/{run_id}/stats")
    tables.log_run(
        spark, f"{out}/runs", run_id, f"addrwatch_{done.suffix}",
        {"data_path": done.data_path, "n_jobs": spark.sparkContext.defaultParallelism,
         "max_rounds": config.MAX_ROUNDS, "optimized_threshold": done.model.threshold},
        {k: v for k, v in done.metrics.items() if v is not None}, done.feature_info, start_ts=done.started,
    )
    drop_scratch(spark, done.split_path, done.scores_path)
    return run_id


def train_and_evaluate(
    spark: SparkSession,
    data_path: str,
    suffix: str,
    out: str,
    run_id: str | None = None,
    bins: int = 16,
    pairs: Sequence[tuple[str, str]] = (),
    interactions: int = 0,
    stats_path: str | None = None,
) -> dict[str, float | None]:
    """Train on one stage, save what came of it, and return the test metrics."""
    done = train(spark, data_path, suffix, bins, pairs, interactions)
    record(spark, done, out, run_id, stats_path)
    return done.metrics


def compare_stages(
    spark: SparkSession,
    source: str,
    out: str,
    start: date = config.START_DATE,
    bins: int = 16,
    pairs: Sequence[tuple[str, str]] = (),
    interactions: int = 0,
) -> DataFrame:
    """Train on each of the three stages; one row of metrics per stage.

    The stages do not depend on each other, so their jobs are submitted side by
    side; the results are saved one after the other, into shared tables. Earlier runs
    below ``out`` stay there and are not part of the result.
    """
    paths = build_stages(spark, source, f"{out}/stages", start)
    with ThreadPoolExecutor(len(config.STAGE_SUFFIXES)) as pool:
        waiting = [pool.submit(train, spark, paths[s], s, bins, pairs, interactions) for s in config.STAGE_SUFFIXES]
        own = [record(spark, job.result(), out, stats_path=paths["stats"]) for job in waiting]
    return stage_metrics(tables.read_runs(spark, f"{out}/runs").filter(F.col("run_id").isin(own)))


def stage_metrics(runs: DataFrame) -> DataFrame:
    names = ["accuracy", "fn", "tp", "fp", "tn"]
    return runs.select("run_name", *[F.col("metrics")[n].alias(n) for n in names])
