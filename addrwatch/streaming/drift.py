"""Drift of the newest predictions, refreshed with every trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from addrwatch import config
from addrwatch.operators.drift import drift_report
from addrwatch.operators.monitor import latest_n
from addrwatch.session import drop_scratch


def drift_stream(
    telemetry: DataFrame,
    baseline: DataFrame,
    out: str,
    n: int = config.DRIFT_SAMPLE,
    ts: str = "ts",
    tie: str | None = "request_id",
    period: str | None = config.DRIFT_PERIOD,
) -> StreamingQuery:
    """Write a drift report per trigger to ``out/reports`` and its index to ``out/metrics``.

    The newest ``n`` rows seen so far are one file of at most ``n`` rows, so a trigger
    reads its own new rows and that file only, never the whole history. Only the last two
    batches' files stay: the one before, in case its successor is run again, and the
    newest. Every write is keyed by the batch and replaces itself if the batch is
    run again; a report and its sample are one row each. Without a ``period`` the stream works off what is there and ends.
    """
    columns = [ts, *([tie] if tie else []), config.TARGET]

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = batch.select(columns)
        if batch_id > 0:
            seen = seen.unionByName(spark.read.schema(seen.schema).parquet(f"{out}/latest/batch={batch_id - 1}"))
        here = f"{out}/latest/batch={batch_id}"
        latest_n(seen, n, ts, tie).coalesce(1).write.mode("overwrite").parquet(here)
        if batch_id > 1:
            drop_scratch(spark, f"{out}/latest/batch={batch_id - 2}")
        report = drift_report(baseline, spark.read.schema(seen.schema).parquet(here), n, ts, tie).coalesce(1)
        report.write.mode("overwrite").parquet(f"{out}/reports/batch={batch_id}")
        samples = spark.read.schema(report.schema).parquet(f"{out}/reports/batch={batch_id}").filter(F.col("psi").isNotNull()).select(
            F.lit("psi").alias("metric"),
            F.create_map(F.lit("target"), F.lit(config.TARGET)).alias("labels"),
            F.current_timestamp().alias("ts"),
            F.col("psi").alias("value"),
        )
        samples.write.mode("overwrite").parquet(f"{out}/metrics/batch={batch_id}")

    writer = telemetry.writeStream.foreachBatch(update).option("checkpointLocation", f"{out}/checkpoint")
    return (writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)).start()
