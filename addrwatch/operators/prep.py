"""Projection, filtering, labelling, sampling and splitting of activity rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from addrwatch import config
from addrwatch.functions import dates, labels, numeric
from addrwatch.operators.stats import class_counts

SAMPLE_KEY = ("address", config.PARTITION_COL)


def select_columns(df: DataFrame, cols: Sequence[str] = config.LOAD_COLS, extra: Sequence[str] = ()) -> DataFrame:
    """Keep the load columns, plus ``extra`` ones such as the sampling key."""
    return df.select(*cols, *[c for c in extra if c not in cols])


def filter_since(df: DataFrame, start: date = config.START_DATE) -> DataFrame:
    return df.filter(F.col(config.PARTITION_COL) >= F.lit(start))


def drop_columns(df: DataFrame, cols: Sequence[str] = (*config.DROP_COLS, config.DATE_COL)) -> DataFrame:
    return df.drop(*cols)


def drop_null_target(df: DataFrame, target: str = config.TARGET) -> DataFrame:
    return df.dropna(subset=[target])


def by_class(df: DataFrame, y: int, target: str = config.TARGET) -> DataFrame:
    return df.filter(F.col(target) == y)


def feature_columns(df: DataFrame, target: str = config.TARGET) -> DataFrame:
    """Every column but the target."""
    return df.select([c for c in df.columns if c != target])


def with_partition_date(df: DataFrame) -> DataFrame:
    return df.withColumn(config.PARTITION_COL, dates.partition_date(F.col("year"), F.col("day")))


def with_transaction_date(df: DataFrame) -> DataFrame:
    return df.withColumn(config.DATE_COL, dates.transaction_date(F.col("year"), F.col("day")))


def with_target(df: DataFrame, null_label: str = "positive") -> DataFrame:
    return df.withColumn(config.TARGET, labels.binary_label(F.col(config.LABEL_COL), null_label))


def row_key(cols: Sequence[str] = SAMPLE_KEY) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def keep_fraction(counts: DataFrame, ratio: float = config.NEGATIVE_RATIO) -> Column:
    """Share of negatives to keep, in [0, 1], as a scalar subquery over the class counts."""
    wanted = F.floor(F.col("positives") * F.lit(ratio))
    share = F.coalesce(F.try_divide(wanted, F.col("negatives")), F.lit(0.0))
    return counts.select(F.least(share, F.lit(1.0)).alias("fraction")).scalar()


def _sampled(fraction: Column, seed: int, key: Sequence[str]) -> Column:
    return numeric.key_hash(row_key(key), seed) < fraction * F.lit(numeric.HASH_RANGE)


def downsample(
    negatives: DataFrame,
    counts: DataFrame,
    ratio: float = config.NEGATIVE_RATIO,
    seed: int = config.SEED,
    key: Sequence[str] = SAMPLE_KEY,
) -> DataFrame:
    """Keep about ``ratio`` negatives per positive, without replacement.

    ``counts`` is ``class_counts`` of the whole set. A row is kept by the hash of
    its key, so the choice does not depend on how rows are laid out and needs no
    shuffle; rows that share a key are kept or dropped together.
    """
    return negatives.filter(_sampled(keep_fraction(counts, ratio), seed, key))


def stratified_split(
    df: DataFrame,
    weights: Sequence[float] = config.SPLIT_WEIGHTS,
    seed: int = config.SEED,
    key: Sequence[str] = SAMPLE_KEY,
) -> DataFrame:
    """Add ``split``: train or test, by the key's hash. Every class is cut the same way."""
    bound = int(weights[0] / sum(weights) * numeric.HASH_RANGE)
    hashed = numeric.key_hash(row_key(key), f"{seed}/split")
    return df.withColumn("split", F.when(hashed < bound, "train").otherwise("test"))


def union_splits(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both parts."""
    return first.unionByName(second)


def split_data(
    df: DataFrame,
    ratio: float = config.NEGATIVE_RATIO,
    weights: Sequence[float] = config.SPLIT_WEIGHTS,
    seed: int = config.SEED,
    target: str = config.TARGET,
    key: Sequence[str] = SAMPLE_KEY,
    counts: DataFrame | None = None,
) -> DataFrame:
    """All positives, the sampled negatives, and a ``split`` column.

    Equal to filtering each class, sampling, splitting and joining the parts
    again, but in a single pass over the rows. ``counts`` may be given where the
    class counts are known, for instance from a cheaper projection of the data.
    """
    counts = class_counts(df, target) if counts is None else counts
    keep = (F.col(target) == 1) | (
        (F.col(target) == 0) & _sampled(keep_fraction(counts, ratio), seed, key)
    )
    return stratified_split(df.filter(keep), weights, seed, key)
