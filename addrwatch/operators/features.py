"""The two feature passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from addrwatch import config
from addrwatch.functions import numeric
from addrwatch.operators.stats import Stats, apply_stats, fit_stats


def log_features(df: DataFrame, cols: Sequence[str] = config.LOG_COLS) -> DataFrame:
    return df.withColumns({numeric.log_name(c): numeric.log_feature(c) for c in cols})


def ratio_features(
    df: DataFrame, pairs: Sequence[tuple[str, str]] = config.FIRST_RATIOS, eps: float = config.EPSILON
) -> DataFrame:
    """One ``<top>_per_<bottom>`` column per pair, all from the columns as they come in."""
    return df.withColumns({
        numeric.ratio_name(top, bottom): numeric.ratio(F.col(top), F.col(bottom), eps)
        for top, bottom in pairs
    })


def drop_raw_logged(df: DataFrame, cols: Sequence[str] = config.LOG_COLS) -> DataFrame:
    return df.drop(*cols)


def z_score(df: DataFrame, stats: Stats, cols: Sequence[str] = config.Z_SCORE_COLS) -> DataFrame:
    return apply_stats(df, stats, cols)


def first_pass(df: DataFrame) -> DataFrame:
    """Logs and first ratios of the raw features, without the raw logged columns."""
    return drop_raw_logged(ratio_features(log_features(df)))


def second_pass(df: DataFrame, stats: Stats) -> DataFrame:
    """Second ratios of the unscaled features, then z-scores in place."""
    return z_score(ratio_features(df, config.SECOND_RATIOS), stats)


def transform(df: DataFrame, stats: Stats | None = None) -> DataFrame:
    """Both passes; the statistics are fitted on the data itself when none are given."""
    passed = first_pass(df)
    return second_pass(passed, fit_stats(passed) if stats is None else stats)


FIRST_PASS_COLS = [
    "length", "weight", "looped",
    *[numeric.log_name(c) for c in config.LOG_COLS],
    *[numeric.ratio_name(*p) for p in config.FIRST_RATIOS],
]
SECOND_PASS_COLS = FIRST_PASS_COLS + [
    numeric.ratio_name(*p) for p in config.SECOND_RATIOS if p not in config.FIRST_RATIOS
]


