"""Numeric expressions: logs, guarded ratios, scaling, hashing and lookup steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from addrwatch import config

HASH_RANGE = 2**32


def log_name(name: str) -> str:
    return f"log_{name}"


def ratio_name(top: str, bottom: str) -> str:
    return f"{top}_per_{bottom}"


def log_feature(name: str) -> Column:
    """Natural log of one plus the column; null at -1 and below."""
    return F.log1p(F.col(name))


def ratio(top: Column, bottom: Column, eps: float = config.EPSILON) -> Column:
    """Quotient with a small constant below, so that 0/0 is 0; null if that sum is 0."""
    return F.try_divide(top, bottom + F.lit(eps))


def safe_std(std: Column, eps: float = config.EPSILON) -> Column:
    """The deviation, or 1 where it is missing or too small to divide by."""
    return F.when(std > eps, std).otherwise(1.0)


def probability(raw: Column) -> Column:
    """Inverse logit."""
    return 1.0 / (1.0 + F.exp(-raw))


def key_hash(key: Column, seed: int | str) -> Column:
    """Whole number in [0, 2**32) that depends on the key and seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def step_value(x: Column, bounds: Sequence[float], values: Sequence[Column | float | int]) -> Column:
    """Value of the half-open step that holds ``x``: ``values[i]`` for
    ``bounds[i-1] <= x < bounds[i]``.

    Written as a balanced decision tree, so a row costs log2(steps) comparisons
    and stays inside generated code.
    """
    if not bounds:
        value = values[0]
        return value if isinstance(value, Column) else F.lit(value)
    mid = len(bounds) // 2
    return F.when(
        x < bounds[mid], step_value(x, bounds[:mid], values[: mid + 1])
    ).otherwise(step_value(x, bounds[mid + 1:], values[mid + 1:]))
