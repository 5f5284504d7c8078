"""Scores against labels: confusion counts, ROC curve, threshold, attributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from addrwatch import config
from addrwatch.functions.labels import apply_threshold, outcome_class
from addrwatch.operators.prefix import running_totals, with_range_totals


def with_prediction(df: DataFrame, threshold: float | Column, score: str = "probability") -> DataFrame:
    return df.withColumn("prediction", apply_threshold(F.col(score), threshold))


def with_outcome(df: DataFrame, y: str = config.TARGET) -> DataFrame:
    return df.withColumn("outcome", outcome_class(F.col(y), F.col("prediction")))


def evaluate(
    df: DataFrame, threshold: float | Column, y: str = config.TARGET, score: str = "probability"
) -> DataFrame:
    """``(accuracy, tp, fn, fp, tn)``; the four counts exist whichever classes occur.
    Rows without a label or a score have no outcome and count nowhere."""
    classed = with_outcome(with_prediction(df.select(y, score), threshold, score), y)
    counts = classed.agg(
        *[F.count_if(F.col("outcome") == name).alias(name) for name in ("tp", "fn", "fp", "tn")],
        F.count("outcome").alias("_rows"),
    )
    accuracy = F.try_divide(F.col("tp") + F.col("tn"), F.col("_rows"))
    return counts.select(accuracy.alias("accuracy"), "tp", "fn", "fp", "tn")


def cumulative_tpr_fpr(
    df: DataFrame,
    y: str = config.TARGET,
    score: str = "probability",
    rows_per_range: int = config.RANGE_ROWS,
) -> DataFrame:
    """``(threshold, tp, fp, tpr, fpr)`` for each distinct score.

    Rows are reduced to one per score before anything is ordered, so equal scores
    cannot pile up in a task. A rate is null if its class is empty.
    """
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(y) == 1).alias("_pos"), F.count_if(F.col(y) == 0).alias("_neg")
    )
    running = running_totals(
        per_score, F.col("threshold"), {"tp": F.col("_pos"), "fp": F.col("_neg")},
        descending=True, rows_per_range=rows_per_range,
    )
    whole = df.agg(
        F.struct(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")).alias("_all")
    ).scalar()
    return running.withColumn("_all", whole).select(
        "threshold", "tp", "fp",
        F.try_divide(F.col("tp"), F.col("_all.pos")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("_all.neg")).alias("fpr"),
    )


def roc_curve(
    df: DataFrame,
    y: str = config.TARGET,
    score: str = "probability",
    rows_per_range: int = config.RANGE_ROWS,
) -> DataFrame:
    """``(threshold, fpr, tpr)``, starting at an infinite threshold where both are 0.

    Points on a straight line between their neighbours are kept; they cannot
    change the best threshold.
    """
    curve = cumulative_tpr_fpr(df, y, score, rows_per_range).select("threshold", "fpr", "tpr")
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(curve)


def _gain(tpr: Column, fpr: Column) -> Column:
    return F.round(F.coalesce(tpr - fpr, F.lit(float("-inf"))), 9)


def bounded_ranges(
    df: DataFrame, y: str = config.TARGET, score: str = "probability", rows_per_range: int = config.RANGE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Rows with their range of scores, and ``(_range, _from_*, _sum_*, pos, neg, edge, upper)`` of each range.

    ``edge`` is tpr - fpr at the range's last score, a point of the curve. ``upper`` would be reached if all of the
    range's positives came before its negatives: no score in it can be above that. Only sums per range are
    shuffled.
    """
    whole = df.agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    whole = whole.select(F.struct("pos", "neg").alias("_all")).scalar()
    adds = {"tp": (F.col(y) == 1).cast("bigint"), "fp": (F.col(y) == 0).cast("bigint")}
    adds = {name: F.coalesce(col, F.lit(0)) for name, col in adds.items()}
    rows, sums = with_range_totals(df.select(y, score), F.col(score), adds, True, rows_per_range)
    sums = sums.withColumn("_all", whole).withColumns({"pos": F.col("_all.pos"), "neg": F.col("_all.neg")}).drop("_all")
    tpr = F.try_divide(F.col("_from_tp") + F.col("_sum_tp"), F.col("pos"))
    edge = _gain(tpr, F.try_divide(F.col("_from_fp") + F.col("_sum_fp"), F.col("neg")))
    upper = _gain(tpr, F.try_divide(F.col("_from_fp"), F.col("neg")))
    return rows, sums.withColumns({"edge": edge, "upper": upper})


def open_ranges(ranges: DataFrame) -> DataFrame:
    """The ranges that may hold the best threshold: those not bounded below the best edge, or below 0, which no score gives."""
    best = ranges.agg(F.greatest(F.max("edge"), F.lit(0.0)).alias("_edge")).scalar()
    return ranges.filter(F.col("upper") >= best)


def best_threshold(
    df: DataFrame,
    y: str = config.TARGET,
    score: str = "probability",
    rows_per_range: int = config.RANGE_ROWS,
) -> DataFrame:
    """One row ``(threshold, j)`` with the largest tpr - fpr, the highest threshold on a tie.

    Branch and bound: the scores are cut into ranges, which are summed; only rows of ranges that
    may hold a better point than the best range's edge are shuffled and sorted. Without positives or
    without negatives no score can beat 0, and the threshold is infinite.
    """
    rows, ranges = bounded_ranges(df, y, score, rows_per_range)
    # Seven numbers per range of rows_per_range rows: a few megabytes for ten billion rows.
    kept = rows.join(F.broadcast(open_ranges(ranges).drop("_part", "edge", "upper")), "_range")
    given = ["_range", "_from_tp", "_from_fp", "pos", "neg"]
    per_score = kept.groupBy(*given, F.col(score).alias("threshold")).agg(F.sum("_add_tp").alias("tp"), F.sum("_add_fp").alias("fp"))
    upto = Window.partitionBy("_range").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    tpr, fpr = (F.try_divide(F.col(f"_from_{n}") + F.sum(n).over(upto), F.col(of)) for n, of in (("tp", "pos"), ("fp", "neg")))
    best = per_score.select(_gain(tpr, fpr).alias("j"), "threshold").agg(F.max(F.struct("j", "threshold")).alias("_best"))
    start = F.struct(F.lit(0.0).alias("j"), F.lit(float("inf")).alias("threshold"))
    return best.select(F.greatest("_best", start).alias("_best")).select("_best.threshold", "_best.j")


def mean_attribution(df: DataFrame, terms: Sequence[str], outcomes: Sequence[str] = ("tp", "fn")) -> DataFrame:
    """``(outcome, term, mean_value)`` per outcome that occurs.

    One wide aggregation that is turned long afterwards. The outcomes are chosen
    inside it: a filter before it would be pushed below the scoring and make every
    row be scored twice.
    """
    wide = df.agg(*[
        F.struct(
            F.count_if(F.col("outcome") == o).alias("n"),
            *[F.avg(F.when(F.col("outcome") == o, F.col(f"`{t}`"))).alias(t) for t in terms],
        ).alias(o)
        for o in outcomes
    ])
    rows = F.array(*[
        F.struct(F.lit(o).alias("outcome"), F.col(o)["n"].alias("n"), F.lit(t).alias("term"), F.col(o)[t].alias("mean_value"))
        for o in outcomes for t in terms
    ])
    return wide.select(F.inline(rows)).filter(F.col("n") > 0).select("outcome", "term", "mean_value")


def rank_terms(df: DataFrame, group: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """Number the terms of each group. A group has one row per model term."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*by, "term")))


def weakest_terms(df: DataFrame, terms: Sequence[str], k: int = config.TOP_TERMS) -> DataFrame:
    """``(outcome, rank, term, mean_value)``: the k lowest mean attributions of true
    positives and of false negatives. An outcome that never occurs gives no rows."""
    ranked = rank_terms(mean_attribution(df, terms), ["outcome"], [F.col("mean_value").asc()])
    return ranked.filter(F.col("rank") <= k).select("outcome", "rank", "term", "mean_value")


def top_terms_abs(df: DataFrame, terms: Sequence[str], k: int = config.TOP_TERMS) -> DataFrame:
    """Add ``top_terms``: the k terms of largest absolute value, sign kept, largest first.

    Sorted inside the row, without a shuffle. Equal sizes go in order of name.
    """
    entries = F.array(*[
        F.struct(
            (-F.abs(F.col(f"`{t}`"))).alias("size"), F.lit(t).alias("term"), F.col(f"`{t}`").alias("value")
        )
        for t in terms
    ])
    return df.withColumn(
        "top_terms", F.transform(F.slice(F.array_sort(entries), 1, k), lambda e: F.struct(e["term"], e["value"]))
    )
