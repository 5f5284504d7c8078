"""Raw activity: CSV in, date-partitioned Parquet out, pruned reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from addrwatch import config, schemas
from addrwatch.operators import prep


def read_activity_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, in the fixed schema; no pass over the data to guess types."""
    return spark.read.schema(schemas.ACTIVITY).option("header", True).csv(path)


def write_activity(
    df: DataFrame,
    path: str,
    max_records: int = config.MAX_RECORDS_PER_FILE,
    tasks: int | None = None,
) -> None:
    """Overwrite the dataset, one folder per date, at most ``max_records`` per file.

    Each writing task opens a file per date it holds, so rows go to ``tasks`` tasks
    by date range (as many as shuffle partitions unless given). A hash of the
    row orders the rows of a date, so a date with very many rows is cut into
    several tasks and every task gets about the same number of rows. Spark finds
    the ranges in a sampling pass over the input.
    """
    if config.PARTITION_COL not in df.columns:
        df = prep.with_partition_date(df)
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(tasks, config.PARTITION_COL, F.xxhash64(*df.columns))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(config.PARTITION_COL)
        .parquet(path)
    )


def read_activity_since(
    spark: SparkSession,
    path: str,
    start: date = config.START_DATE,
    extra: Sequence[str] = (),
    schema: StructType = schemas.ACTIVITY_BY_DATE,
) -> DataFrame:
    """Load columns (and ``extra`` ones) of the partitions from ``start`` on.

    The schema is given, so no file is opened to find it and columns that only some files have are null elsewhere.
    """
    return prep.filter_since(prep.select_columns(spark.read.schema(schema).parquet(path), extra=extra), start)
