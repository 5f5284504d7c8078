from __future__ import annotations

import glob
import json
import os
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from addrwatch import config, schemas, views
from addrwatch.operators import runs
from addrwatch.plans import training
from addrwatch.session import scratch_dir
from addrwatch.sources import activity, tables


def test_csv_has_a_fixed_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "address,year,day,length,weight,count,looped,neighbors,income,label\n"
        "x1,2016,11,18,0.008,1,0,2,100050000.0,princetonCerber\n")
    df = activity.read_activity_csv(spark, str(tmp_path))
    assert df.schema == schemas.ACTIVITY
    assert df.first()["income"] == 100050000.0


def test_files_hold_at_most_max_records(spark, tmp_path):
    rows = spark.range(2500).select(
        F.col("id").cast("string").alias("address"), F.lit(2020).alias("year"),
        F.when(F.col("id") < 2400, 7).otherwise(F.col("id") % 5 + 1).cast("int").alias("day"), F.lit(1.0).alias("income"))
    path = str(tmp_path / "set")
    activity.write_activity(rows, path, max_records=300)
    hot = glob.glob(f"{path}/partition_date=2020-01-07/*.parquet")
    assert len(hot) >= 8
    assert all(spark.read.parquet(f).count() <= 300 for f in hot)
    assert spark.read.parquet(path).count() == 2500
    activity.write_activity(rows.limit(10), path)
    assert spark.read.parquet(path).count() == 10


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("address"), F.lit(2020).alias("year"),
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 300 + 1).cast("int").alias("day"))
    path = str(tmp_path / "set")
    activity.write_activity(rows, path, tasks=4)
    assert len(glob.glob(f"{path}/partition_date=2020-01-07/*.parquet")) >= 2


def test_telemetry_forms(spark, tmp_path):
    entries = [{"timestamp": "2024-01-01T10:00:00.5+01:00", "is_ransomware": True, "confidence": 0.75},
               {"timestamp": "2024-01-01T10:00:01+01:00", "is_ransomware": False, "confidence": 0.25}]
    (tmp_path / "live.json").write_text(json.dumps(entries))
    read = tables.read_telemetry(spark, str(tmp_path / "live.json"), form="json").orderBy("timestamp")
    assert [r["is_ransomware"] for r in read.collect()] == [True, False]
    assert read.select(F.date_format("timestamp", "HH:mm:ss")).first()[0] == "09:00:00"
    path = str(tmp_path / "table")
    tables.append_telemetry(read, path)
    tables.append_telemetry(read.limit(1), path)
    assert tables.read_telemetry(spark, path).count() == 3


def test_unfitted_statistics_are_refused(tmp_path):
    with pytest.raises(RuntimeError, match="not fitted"):
        tables.save_stats(None, str(tmp_path / "s"))


def test_best_run(spark, tmp_path):
    path = str(tmp_path / "runs")

    def log(run_id, suffix, fn, status="FINISHED", day=1):
        tables.log_run(spark, path, run_id, f"x_{suffix}", {"n": 1}, {"fn": fn}, status=status, start_ts=datetime(2024, 1, day))

    log("a", "feature_eng_2", 5)
    log("b", "feature_eng_2", 3, day=2)
    log("c", "feature_eng_1", 0)
    log("d", "feature_eng_2", 1, status="FAILED")
    log("e", "feature_eng_2", 3, day=3)
    assert runs.best_run(tables.read_runs(spark, path)).first()["run_id"] == "e"
    assert runs.finished_runs(tables.read_runs(spark, path)).count() == 3


def test_scratch_dir_needs_a_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_training_writes_everything_down(spark, sf, tmp_path):
    out, stage = str(tmp_path / "out"), str(tmp_path / "stage")
    tables.write_stage(views.labelled(spark, sf), stage)
    metrics = training.train_and_evaluate(spark, stage, "baseline", out, run_id="r1", bins=4)
    logged = tables.read_runs(spark, f"{out}/runs").first()
    assert logged["run_id"] == "r1" and logged["status"] == "FINISHED"
    assert logged["metrics"]["tp"] == metrics["tp"]
    assert set(logged["params"]) == {"data_path", "n_jobs", "max_rounds", "optimized_threshold"}
    assert set(logged["feature_info"]) == {config.TP_WEAKEST, config.FN_STRONGEST}
    assert len(logged["feature_info"][config.TP_WEAKEST]) == 5
    model = tables.load_model(spark, f"{out}/models/r1")
    assert set(model.term_names) == set(config.RAW_FEATURES)
    assert repr(model.threshold) == logged["params"]["optimized_threshold"]
    base = {r["value"]: r["n"] for r in tables.load_baseline(spark, f"{out}/training_baseline").collect()}
    assert base[True] > 0 and base[False] > 0


def test_scratch_of_a_training_is_deleted_and_results_are_those_of_the_call(spark, sf, tmp_path):
    out = str(tmp_path / "out")
    activity.write_activity(views.tx(spark, sf), str(tmp_path / "activity"))
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    for _ in range(2):
        found = training.compare_stages(spark, str(tmp_path / "activity"), out, date(1990, 1, 1), bins=3).collect()
        assert sorted(r["run_name"] for r in found) == [f"addrwatch_{s}" for s in sorted(config.STAGE_SUFFIXES)]
    assert set(os.listdir(shared)) == before
    runs = tables.read_runs(spark, f"{out}/runs").collect()
    assert len(runs) == 6
    for r in runs:
        assert tables.load_stats(spark, f"{out}/models/{r['run_id']}/stats").count() == 5


def test_a_stage_keeps_its_schema(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.createDataFrame([(1, 2.5, "x"), (0, None, "é")], "is_ransomware int, `odd name` double, note string")
    tables.write_stage(df, path)
    tables.write_stage(df, path)
    read = tables.read_stage(spark, path)
    assert read.schema == df.schema
    assert sorted(map(tuple, read.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert tables.read_stage(spark, tables.write_stage(df.limit(0), path)).count() == 0
    df.write.mode("overwrite").parquet(path)
    with pytest.raises(AnalysisException):
        tables.read_stage(spark, path)
