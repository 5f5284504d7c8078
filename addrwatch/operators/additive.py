"""Additive glass-box model: a score per term and bin, summed and squashed.

Fitting is a logistic regression over one-hot bins with Spark ML. The fitted
model is a short table (terms x bins), so scoring writes it into the query as
constants: no join, no UDF, the same in batch and streaming.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, OneHotEncoder, QuantileDiscretizer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from addrwatch import config, schemas
from addrwatch.functions.labels import apply_threshold
from addrwatch.functions.numeric import probability, step_value


@dataclass(frozen=True)
class Term:
    """One feature, or two whose bins are crossed.

    ``cuts`` holds the inner bin bounds per feature. ``scores`` holds one number
    per bin (first feature major), the bin for missing values last.
    """

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    scores: tuple[float, ...]

    @property
    def name(self) -> str:
        return pair_name(*self.features)

    def column(self) -> Column:
        x = F.col(self.features[0]).cast("double")
        missing = x.isNull() | F.isnan(x)
        if len(self.features) == 1:
            value = step_value(x, self.cuts[0], self.scores[:-1])
        else:
            y = F.col(self.features[1]).cast("double")
            missing = missing | y.isNull() | F.isnan(y)
            width = len(self.cuts[1]) + 1
            rows = [
                step_value(y, self.cuts[1], self.scores[i * width:(i + 1) * width])
                for i in range(len(self.cuts[0]) + 1)
            ]
            value = step_value(x, self.cuts[0], rows)
        return F.when(missing, F.lit(self.scores[-1])).otherwise(value)


@dataclass(frozen=True)
class AdditiveModel:
    terms: tuple[Term, ...]
    intercept: float
    threshold: float = config.DEFAULT_THRESHOLD

    @property
    def term_names(self) -> list[str]:
        return [t.name for t in self.terms]

    def with_threshold(self, threshold: float) -> AdditiveModel:
        return replace(self, threshold=threshold)


def pair_name(*features: str) -> str:
    return " & ".join(features)


def _trained(model: AdditiveModel | None) -> AdditiveModel:
    if model is None or not model.terms:
        raise RuntimeError("A model that was not trained has no scores.")
    return model


def pair_terms(df: DataFrame, a: str, b: str, bins: int, out: str) -> DataFrame:
    """Cross two bin columns (each 0..bins) into one bin id."""
    return df.withColumn(out, F.col(a) * F.lit(bins + 1) + F.col(b))


def _binned(df: DataFrame, cols: Sequence[str], bins: int, prefix: str) -> tuple[DataFrame, list[list[float]]]:
    """Quantile bins of the columns; missing values go to the bin after the last."""
    outs = [f"{prefix}{c}" for c in cols]
    cut = QuantileDiscretizer(
        inputCols=list(cols), outputCols=outs, numBucketsArray=[bins] * len(cols),
        handleInvalid="keep", relativeError=0.001,
    ).fit(df)
    splits = [[v for v in s if math.isfinite(v)] for s in cut.getSplitsArray()]
    ready = Bucketizer(
        inputCols=list(cols), outputCols=outs, splitsArray=cut.getSplitsArray(), handleInvalid="keep"
    )
    return ready.transform(df), splits


def fit_additive(
    df: DataFrame,
    features: Sequence[str],
    target: str = config.TARGET,
    bins: int = 16,
    pairs: Sequence[tuple[str, str]] = (),
    pair_bins: int = 4,
    max_iter: int = config.MAX_ROUNDS,
    reg: float = 1e-4,
    tol: float = 1e-4,
) -> AdditiveModel:
    """Fit the model on the distributed rows.

    At most ``max_iter`` rounds, fewer once the loss stops improving by ``tol``.
    Only bin bounds and coefficients, a few hundred numbers, come to the driver.
    Give a stored frame: it is read once per column group and once by the
    optimiser, which then keeps its own packed copy.
    """
    as_double = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in features]
    frame, cuts = _binned(df.select(target, *as_double), features, bins, "_bin_")
    slots: list[tuple[tuple[str, ...], list[list[float]], str, int]] = [
        ((c,), [cuts[i]], f"_bin_{c}", len(cuts[i]) + 2) for i, c in enumerate(features)
    ]
    if pairs:
        paired = sorted({c for p in pairs for c in p})
        frame, coarse = _binned(frame, paired, pair_bins, "_coarse_")
        inner = dict(zip(paired, coarse))
        for a, b in pairs:
            out = f"_pair_{a}_{b}"
            frame = pair_terms(frame, f"_coarse_{a}", f"_coarse_{b}", pair_bins, out)
            # Rows with a missing side share one slot of their own.
            whole = (pair_bins + 1) ** 2
            missing = F.isnan(a) | F.isnan(b)
            frame = frame.withColumn(out, F.when(missing, F.lit(float(whole))).otherwise(F.col(out)))
            slots.append(((a, b), [inner[a], inner[b]], out, whole + 1))
    ids = [slot[2] for slot in slots]
    # A known number of categories per column keeps the encoder from depending on
    # which bins happen to occur.
    sizes = F.array(*[F.lit(slot[3]) for slot in slots])
    ladder = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.array_max(sizes) - 1)).alias("_i"))
    ladder = ladder.select(*[
        F.least(F.col("_i"), F.lit(slot[3] - 1)).cast("double").alias(slot[2]) for slot in slots
    ])
    encoder = OneHotEncoder(inputCols=ids, outputCols=[f"{c}_hot" for c in ids], dropLast=False).fit(ladder)
    assembler = VectorAssembler(inputCols=[f"{c}_hot" for c in ids], outputCol="_features")
    learner = LogisticRegression(
        featuresCol="_features", labelCol=target, maxIter=max_iter, regParam=reg, tol=tol,
        standardization=False,
    )
    # Adding zero sheds the bin names the discretizer attached to each column.
    plain = frame.select(target, *[(F.col(c) + F.lit(0.0)).alias(c) for c in ids])
    fitted = Pipeline(stages=[encoder, assembler, learner]).fit(plain).stages[-1]
    weights, at, terms = fitted.coefficients.toArray(), 0, []
    for names, bounds, _, size in slots:
        part = [float(v) for v in weights[at:at + size]]
        at += size
        if len(names) == 2:
            part = _pair_scores(part, bounds, pair_bins)
        terms.append(Term(names, tuple(tuple(b) for b in bounds), tuple(part)))
    return AdditiveModel(tuple(terms), float(fitted.intercept))


def _pair_scores(part: list[float], bounds: list[list[float]], pair_bins: int) -> list[float]:
    """Scores of the crossed bins that exist, then the one for a missing side."""
    rows, cols = (len(b) + 1 for b in bounds)
    return [part[i * (pair_bins + 1) + j] for i in range(rows) for j in range(cols)] + [part[-1]]


def strongest_pairs(
    df: DataFrame,
    model: AdditiveModel,
    features: Sequence[str],
    k: int,
    target: str = config.TARGET,
    bins: int = 4,
) -> list[tuple[str, str]]:
    """The k pairs of features whose crossed bins explain most of what a model leaves.

    Every pair's cells are summed in one pass; a cell's gain is its squared
    residual sum over its variance. Only a number per pair comes to the driver.
    """
    as_double = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in features]
    scored = explain(df, model).select(
        *as_double, (F.col(target) - F.col("probability")).alias("_rest"),
        (F.col("probability") * (1 - F.col("probability"))).alias("_spread"))
    frame, _ = _binned(scored, features, bins, "_bin_")
    sums = _cell_sums(frame.select("_rest", "_spread", *[F.col(f"_bin_{c}").cast("int") for c in features]), features, bins + 1)
    gains = sums.groupBy("a", "b").agg(F.sum(F.col("rest") ** 2 / (F.col("spread") + 1.0)).alias("gain"))
    return [(r["a"], r["b"]) for r in gains.orderBy(F.desc("gain"), "a", "b").limit(k).collect()]


def _cell_sums(frame: DataFrame, features: Sequence[str], width: int) -> DataFrame:
    """``(a, b, cell, rest, spread)``: sums of residuals and variances in each pair's cells, first feature major.

    A task adds up all cells of its rows, batch by batch, and gives a row for each: far fewer than a row per pair and row. Rows
    without a residual add nothing.
    """
    pairs = [(i, j) for i in range(len(features)) for j in range(i + 1, len(features))]
    names = list(features)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(pairs), width * width))
        for batch in batches:
            rest, spread = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.float64) for c in range(2))
            bins = [np.asarray(column.to_numpy(zero_copy_only=False), np.int64) for column in batch.columns[2:]]
            known = [~np.isnan(rest), ~np.isnan(spread)]
            rest, spread = (np.where(k, v, 0.0) for k, v in zip(known, (rest, spread), strict=True))
            for p, (i, j) in enumerate(pairs):
                cell = bins[i] * width + bins[j]
                for at, weights in enumerate((None, rest, spread)):
                    total[at, p] += np.bincount(cell, weights, width * width)
        p, cell = np.nonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[pairs[k][0]] for k in p], pa.string()), pa.array([names[pairs[k][1]] for k in p], pa.string()),
             pa.array(cell.astype(np.float64)), pa.array(total[1][p, cell]), pa.array(total[2][p, cell])],
            ["a", "b", "cell", "rest", "spread"])

    parts = frame.mapInArrow(summed, "a string, b string, cell double, rest double, spread double")
    return parts.groupBy("a", "b", "cell").agg(F.sum("rest").alias("rest"), F.sum("spread").alias("spread"))


def term_scores(df: DataFrame, model: AdditiveModel) -> DataFrame:
    """Add the contribution of each term as struct ``terms``."""
    model = _trained(model)
    return df.withColumn("terms", F.struct(*[t.column().alias(t.name) for t in model.terms]))


def explain(df: DataFrame, model: AdditiveModel) -> DataFrame:
    """Add ``terms`` and ``probability``."""
    model = _trained(model)
    total = F.lit(model.intercept)
    for name in model.term_names:
        total = total + F.col("terms")[name]
    return term_scores(df, model).withColumn("probability", probability(total))


def attribution_map(model: AdditiveModel) -> Column:
    """The ``terms`` struct as a map from term to value."""
    names = model.term_names
    return F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col("terms")[n] for n in names])
    )


def predict(df: DataFrame, model: AdditiveModel) -> DataFrame:
    """``explain`` plus ``prediction``, each row scored once."""
    return explain(df, model).withColumn(
        "prediction", apply_threshold(F.col("probability"), model.threshold)
    )


# ------------------------------------------------------------ table form


def model_tables(spark: SparkSession, model: AdditiveModel) -> tuple[DataFrame, DataFrame]:
    """The model as its two tables: term bins, and intercept with threshold."""
    rows = []
    for term in _trained(model).terms:
        edges = [(-math.inf, *c, math.inf) for c in term.cuts]
        spans = [list(zip(e, e[1:])) for e in edges]
        if len(spans) == 1:
            cells = [(lo, hi, None, None) for lo, hi in spans[0]]
        else:
            cells = [(lo, hi, lo2, hi2) for lo, hi in spans[0] for lo2, hi2 in spans[1]]
        cells.append((None, None, None, None))
        rows += [(term.name, i, *cell, s) for i, (cell, s) in enumerate(zip(cells, term.scores))]
    return (
        spark.createDataFrame(rows, schemas.MODEL_TERMS),
        spark.createDataFrame([(model.intercept, float(model.threshold))], schemas.MODEL_HEAD),
    )


def model_from_tables(terms: DataFrame, head: DataFrame) -> AdditiveModel:
    """Read the two tables back. They are as small as the model: terms x bins rows."""
    found = sorted(terms.collect(), key=lambda r: (r["term"], r["bin"]))
    built = []
    for name, group in groupby(found, key=lambda r: r["term"]):
        cells = list(group)
        cuts = [tuple(sorted({c["lo"] for c in cells if c["lo"] is not None and math.isfinite(c["lo"])}))]
        if cells[0]["lo2"] is not None:
            cuts.append(tuple(sorted({c["lo2"] for c in cells if c["lo2"] is not None and math.isfinite(c["lo2"])})))
        built.append(Term(tuple(name.split(" & ")), tuple(cuts), tuple(c["score"] for c in cells)))
    row = head.first()
    return AdditiveModel(tuple(built), row["intercept"], row["threshold"])
