"""From stored activity to model-ready stages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from addrwatch import config
from addrwatch.operators import features, prep
from addrwatch.operators.stats import fit_stats
from addrwatch.sources import activity, tables


def label_activity(df: DataFrame, null_label: str = "positive") -> DataFrame:
    """Target instead of label and date columns, for rows with any columns besides."""
    dated = prep.with_transaction_date(df)
    return prep.drop_null_target(prep.drop_columns(prep.with_target(dated, null_label)))


def preprocess(
    spark: SparkSession,
    path: str,
    start: date = config.START_DATE,
    null_label: str = "positive",
    keep_key: bool = True,
) -> DataFrame:
    """Labelled rows from ``start`` on.

    ``keep_key`` keeps address and date, which sampling needs; without it the
    columns are the raw features and the target.
    """
    extra = ["address"] if keep_key else []
    rows = prep.with_target(
        prep.with_transaction_date(activity.read_activity_since(spark, path, start, extra)), null_label
    )
    spare = [c for c in (*config.DROP_COLS, config.DATE_COL) if not (keep_key and c == config.PARTITION_COL)]
    return prep.drop_null_target(prep.drop_columns(rows, spare))


def build_stages(spark: SparkSession, source: str, out: str, start: date = config.START_DATE) -> dict[str, str]:
    """Write the preprocessed, first-pass and second-pass stages and the statistics.

    Each stage is read back from its table, so a later step never repeats an
    earlier one, also after executors are lost.
    """
    paths = {name: f"{out}/{name}" for name in (*config.STAGE_SUFFIXES, "stats")}
    baseline, first, second = config.STAGE_SUFFIXES
    tables.write_stage(preprocess(spark, source, start), paths[baseline])
    tables.write_stage(features.first_pass(tables.read_stage(spark, paths[baseline])), paths[first])
    passed = tables.read_stage(spark, paths[first])
    tables.save_stats(fit_stats(passed), paths["stats"])
    stats = tables.load_stats(spark, paths["stats"])
    tables.write_stage(features.second_pass(passed, stats), paths[second])
    return paths
