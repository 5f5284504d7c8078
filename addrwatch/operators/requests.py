"""Checks on scoring requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from addrwatch import config

RULES = [f"neg_{c}" for c in config.RAW_FEATURES]


def _names_where(conditions: Mapping[str, Column]) -> Column:
    """The names whose condition holds, in order."""
    found = F.array(*[F.when(condition, F.lit(name)) for name, condition in conditions.items()])
    return F.array_except(found, F.array(F.lit(None).cast("string")))


def is_complete(cols: Sequence[str] = config.RAW_FEATURES) -> Column:
    """Every required field is there; plain null tests, which sources can apply."""
    complete = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        complete = complete & F.col(c).isNotNull()
    return complete


def required_fields(df: DataFrame, cols: Sequence[str] = config.RAW_FEATURES) -> DataFrame:
    """Add ``missing_fields``: names of the required fields that are absent or null."""
    return df.withColumn("missing_fields", _names_where({c: F.col(c).isNull() for c in cols}))


def valid_requests(df: DataFrame) -> DataFrame:
    return df.filter(is_complete())


def rejected_requests(df: DataFrame) -> DataFrame:
    """Incomplete requests with their ``missing_fields``."""
    return required_fields(df.filter(~is_complete()))


def negative_flags(df: DataFrame) -> DataFrame:
    """Add ``quality_rules``: ``neg_<field>`` for each field below zero."""
    below = {rule: F.col(c) < 0 for rule, c in zip(RULES, config.RAW_FEATURES)}
    return df.withColumn("quality_rules", _names_where(below))


def broken_rules() -> dict[str, Column]:
    """Per rule: a complete request has a negative value there."""
    return {rule: is_complete() & (F.col(c) < 0) for rule, c in zip(RULES, config.RAW_FEATURES)}


def quality_issues(df: DataFrame) -> DataFrame:
    """One row per complete request and broken rule."""
    return negative_flags(valid_requests(df)).withColumn("quality_rule", F.explode("quality_rules"))


def quality_counts(df: DataFrame) -> DataFrame:
    """``(quality_rule, n)``, summed per rule before the few totals are turned long."""
    wide = df.agg(*[F.count_if(broken).alias(rule) for rule, broken in broken_rules().items()])
    return wide.unpivot([], RULES, "quality_rule", "n").filter(F.col("n") > 0)
