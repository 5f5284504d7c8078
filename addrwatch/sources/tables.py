"""Stage, baseline, statistics, model, run, telemetry and metric tables."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from addrwatch import config, schemas
from addrwatch.operators.additive import AdditiveModel, model_from_tables, model_tables
from addrwatch.operators.stats import training_baseline


def write_stage(df: DataFrame, path: str) -> str:
    """Overwrite the table, and write its schema last to ``_schema`` beside the rows, which readers of rows pass over."""
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.text(f"{path}/_schema")
    return path


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The table in the schema it was written with; one whose writing never ended has none and can't be read."""
    schema = "".join(r["value"] for r in spark.read.text(f"{path}/_schema").collect())
    return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(path)


def read_requests(
    spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """JSON scoring requests as a table or as a stream."""
    if not streaming:
        return spark.read.schema(schemas.REQUEST).json(path)
    reader = spark.readStream.schema(schemas.REQUEST)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def append_telemetry(df: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery | None:
    """Append ``(timestamp, is_ransomware, confidence)`` rows; earlier files stay as they are."""
    rows = df.select("timestamp", config.TARGET, "confidence")
    if not df.isStreaming:
        rows.write.mode("append").parquet(path)
        return None
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_telemetry(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Telemetry rows, from Parquet or from files that hold one JSON array each."""
    if form == "parquet":
        return spark.read.parquet(path)
    rows = spark.read.schema(schemas.TELEMETRY_JSON).option("multiLine", True).json(path)
    return rows.withColumn("timestamp", F.to_timestamp("timestamp"))


def save_baseline(train: DataFrame, path: str, run_id: str | None = None) -> None:
    """Class counts of the training rows; each training run replaces the last ones."""
    training_baseline(train, run_id=run_id).write.mode("overwrite").parquet(path)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BASELINE).parquet(path)


def save_stats(stats: DataFrame | None, path: str) -> None:
    if stats is None:
        raise RuntimeError("Feature statistics are not fitted yet.")
    stats.write.mode("overwrite").parquet(path)


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STATS).parquet(path)


def save_model(spark: SparkSession, model: AdditiveModel, path: str) -> None:
    terms, head = model_tables(spark, model)
    terms.coalesce(1).write.mode("overwrite").parquet(f"{path}/terms")
    head.coalesce(1).write.mode("overwrite").parquet(f"{path}/head")


def load_model(spark: SparkSession, path: str) -> AdditiveModel:
    return model_from_tables(
        spark.read.schema(schemas.MODEL_TERMS).parquet(f"{path}/terms"),
        spark.read.schema(schemas.MODEL_HEAD).parquet(f"{path}/head"),
    )


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    feature_info: Mapping[str, Mapping[str, float]] | None = None,
    status: str = "FINISHED",
    start_ts: datetime | None = None,
) -> None:
    """Append one run to the registry table."""
    row = (
        run_id, run_name, status, start_ts or datetime.now(),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
        {k: dict(v) for k, v in (feature_info or {}).items()},
    )
    spark.createDataFrame([row], schemas.RUN).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN).parquet(path)


def metric_samples(df: DataFrame, metric: str, labels: Mapping[str, str], ts: str, value: str) -> DataFrame:
    """Rows of the metric table; ``labels`` names the column behind each label."""
    pairs = [part for name, col in labels.items() for part in (F.lit(name), F.col(col).cast("string"))]
    mapped = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return df.select(
        F.lit(metric).alias("metric"), mapped.alias("labels"),
        F.col(ts).alias("ts"), F.col(value).cast("double").alias("value"),
    )


def publish_metric(samples: DataFrame, path: str) -> None:
    samples.write.mode("append").parquet(path)
