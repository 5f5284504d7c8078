"""Running totals over a global order, without a global sort in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from addrwatch import config

_SPARE = ["_order", "_range", "_part", "_tie"]
# Small tables are cut into so many ranges, for as many tasks.
_LEAST_RANGES = 8


def _cuts(df: DataFrame, col: str, ranges: int) -> tuple[list[float], dict[float, int]]:
    """Cut points that split the rows into about equal parts, and how many parts a hot value fills.

    A value that fills a whole part by itself shows up as a repeated quantile. It
    is given a range of its own: a cut at the value and one right after it.
    """
    if ranges < 2:
        return [], {}
    found = df.approxQuantile(col, [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    repeated: dict[float, int] = {}
    for a, b in zip(found, found[1:]):
        if a == b:
            repeated[a] = repeated.get(a, 1) + 1
    return sorted(set(found) | {math.nextafter(v, math.inf) for v in repeated}), repeated


def _bucket(df: DataFrame, col: str, cuts: list[float], out: str) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    cut = Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="error").transform(df)
    return cut.withColumn(out, F.col(out).cast("int"))


def _tie_cuts(df: DataFrame, hot: dict[float, int]) -> DataFrame:
    """``(_hot, _cuts)``: quantiles of the tie-break of each hot value, as many as the ranges it fills.

    Values that fill about equally many, up to a factor of two, are cut by one job.
    """
    spark, rows = df.sparkSession, []
    for power in sorted({n.bit_length() for n in hot.values()}):
        values, parts = [v for v, n in hot.items() if n.bit_length() == power], 1 << power
        steps = [i / parts for i in range(1, parts)]
        own = df.join(F.broadcast(spark.createDataFrame([(v,) for v in values], "_order double")), "_order")
        quantiles = own.groupBy("_order").agg(F.percentile_approx(F.col("_tie").cast("double"), steps, 4 * parts).alias("cuts"))
        rows += [(r["_order"], sorted(set(r["cuts"]))) for r in quantiles.collect()]
    return spark.createDataFrame(rows, "_hot double, _cuts array<double>")


def _place(cuts: Column, value: Column) -> Column:
    """How many of the ascending cuts are at most the value: first among every w-th cut, then among w of them."""
    width = F.ceil(F.sqrt(F.size(cuts))).cast("int")
    every = F.filter(F.transform(F.sequence(F.lit(1), F.floor(F.size(cuts) / width).cast("int")), lambda i: F.element_at(cuts, (i * width).cast("int"))),
                     lambda x: x <= value)
    passed = F.when(F.size(cuts) >= width, F.size(every)).otherwise(0) * width
    return (passed + F.size(F.filter(F.slice(cuts, passed + 1, width), lambda x: x <= value))).cast("int")


def ranged(df: DataFrame, order: Column, tie: Column | None, descending: bool, rows_per_range: int) -> DataFrame:
    """Rows with an order, with ``_order``, ``_tie`` and their place among ranges in order: (``_range``, ``_part``).

    The cut points come first, from narrow scans, because all branches of a plan must share them.
    """
    return _ranged(df, order, tie, descending, rows_per_range)[0]


def _ranged(df: DataFrame, order: Column, tie: Column | None, descending: bool, rows_per_range: int) -> tuple[DataFrame, int]:
    """``ranged`` and how many values ``_range`` may have."""
    sign = -1.0 if descending else 1.0
    df = df.withColumn("_order", order.cast("double") * F.lit(sign) + F.lit(0.0)).withColumn("_tie", F.lit(0) if tie is None else tie)
    df = df.filter(F.col("_order").isNotNull() & ~F.isnan("_order"))
    ranges = max(-(-df.count() // rows_per_range), _LEAST_RANGES)
    cuts, hot = _cuts(df.select("_order"), "_order", ranges)
    df = _bucket(df, "_order", cuts, "_range")
    if tie is None or not hot:
        return df.withColumn("_part", F.lit(0)), len(cuts) + 1
    # At most two numbers per range: a megabyte for ten billion rows. A merge join would gather each hot value in one task.
    cut = df.join(F.broadcast(_tie_cuts(df.select("_order", "_tie"), hot)), F.col("_order") == F.col("_hot"), "left")
    part = F.when(F.col("_cuts").isNull() | F.col("_tie").isNull(), 0).otherwise(_place(F.col("_cuts"), F.col("_tie").cast("double")))
    return cut.withColumn("_part", part).drop("_hot", "_cuts"), len(cuts) + 1


def _offsets(df: DataFrame, totals: Mapping[str, Column], ranges: int) -> DataFrame:
    """``(_range, _part, _sum_*, _from_*)``: each range's own totals and those of all ranges before it.

    Ranges are summed into blocks of about the root of their number. The block sums are one short
    array, each block's offset a sum over it; a window adds up the ranges before each inside its block.
    """
    sums = df.groupBy("_range", "_part").agg(*[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in totals])
    sums = sums.withColumn("_block", F.floor(F.col("_range") / math.ceil(math.sqrt(ranges))))
    blocks = sums.groupBy("_block").agg(*[F.sum(f"_sum_{n}").alias(f"_all_{n}") for n in totals])
    listed = blocks.agg(F.collect_list(F.struct("_block", *[f"_all_{n}" for n in totals])).alias("_blocks")).scalar()
    inside = Window.partitionBy("_block").orderBy("_range", "_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_blocks", listed)
    before = F.filter("_blocks", lambda b: b["_block"] < F.col("_block"))

    def offset(name: str) -> Column:
        zero = F.lit(0).cast(sums.schema[f"_sum_{name}"].dataType)
        blocks_before = F.aggregate(before, zero, lambda total, b: total + F.coalesce(b[f"_all_{name}"], zero))
        return (F.coalesce(F.sum(f"_sum_{name}").over(inside), zero) + blocks_before).alias(f"_from_{name}")

    return sums.select("_range", "_part", *[f"_sum_{name}" for name in totals], *map(offset, totals))


def here() -> WindowSpec:
    """The rows of a range in their order."""
    return Window.partitionBy("_range", "_part").orderBy("_order", "_tie")


def with_range_totals(
    df: DataFrame, order: Column, totals: Mapping[str, Column], descending: bool, rows_per_range: int
) -> tuple[DataFrame, DataFrame]:
    """Rows with their range and ``_add_*``, and each range's totals (``_offsets``): the rows aren't shuffled for either."""
    df, ranges = _ranged(df, order, None, descending, rows_per_range)
    df = df.withColumns({f"_add_{name}": col for name, col in totals.items()})
    return df, _offsets(df, totals, ranges)


def running_totals(
    df: DataFrame,
    order: Column,
    totals: Mapping[str, Column],
    tie: Column | None = None,
    descending: bool = False,
    rows_per_range: int = config.RANGE_ROWS,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``name``: the total of its column over all rows up to this one.

    Rows are ordered by the number ``order`` (exact as a double), then by the number
    ``tie``; rows without an order, null or NaN, are left out. The order is cut at its quantiles into
    ranges of about ``rows_per_range`` rows; each range is summed, the range sums give every range its offset
    in two levels, and a window runs inside each range only. A single hot ``order`` value has a
    range of its own, cut once more by ``tie``, without which its rows count in any order. Cut points
    decide how even the ranges are, never the result. The rows themselves must be
    repeatable, as for any Spark job that may lose an executor.

    The rows are shuffled once, by range: the join with the offsets and the window share that.
    ``extra`` names further columns computed from the totals, in window order, over ``here()``.
    """
    df, ranges = _ranged(df, order, tie, descending, rows_per_range)
    df = df.withColumns({f"_add_{name}": col for name, col in totals.items()})
    within = here().rowsBetween(Window.unboundedPreceding, 0)
    joined = df.join(_offsets(df, totals, ranges).drop(*[f"_sum_{n}" for n in totals]), ["_range", "_part"])
    found = joined.withColumns({n: F.sum(f"_add_{n}").over(within) + F.col(f"_from_{n}") for n in totals})
    if extra:
        found = found.withColumns(dict(extra))
    return found.drop(*_SPARE, *[f"{p}_{n}" for p in ("_add", "_from") for n in totals])
