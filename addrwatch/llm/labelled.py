"""Bounded samples of labelled documents, and logistic calibration on a few numbers per document."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo a number."""
    return F.crc32(F.col(id_col).cast("string")) % modulus


def chosen(labels: DataFrame, label: str, keep: Column, rows: int, salt: str, per_class: bool = False,
           id_col: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled identifiers (of each class), picked by a hash of the identifier.

    Null labels and identifiers are left out, and so are identifiers with both labels.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).where(keep)
             .groupBy(F.col(id_col).alias("doc_id"))
             .agg(F.min(label).alias("label"), F.max(label).alias("_most")).where("label = _most").drop("_most"))
    order = F.xxhash64("doc_id", F.lit(salt))
    parts = [known.where(F.col("label") == c) for c in (0, 1)] if per_class else [known]
    picked = [p.orderBy(order, "doc_id").limit(rows) for p in parts]
    return picked[0] if len(picked) == 1 else picked[0].unionByName(picked[1])


def with_texts(docs: DataFrame, picked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, label, text) of chosen identifiers; these are few, so the documents aren't shuffled."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])


class Logistic:
    """Probability of label 1 from a few numbers, fitted by Newton steps with a slight ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40):
        x, y = np.asarray(x, float), np.asarray(y, float)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        self.scale = np.maximum(x.std(axis=0), 1e-9) if len(x) else np.ones(x.shape[1])
        z = self._design(x)
        # One row of each label is added, so that a class without rows gives no certainty.
        self.weights = np.zeros(z.shape[1])
        self.weights[0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(steps if 0 < y.sum() < len(y) else 0):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            gradient = z.T @ (p - y) + penalty * self.weights
            curve = (z * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, gradient)
            self.weights -= step * min(1.0, 4 / max(1e-12, float(np.abs(step).max())))
            if np.abs(step).max() < 1e-8:
                break

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack((np.ones(len(x)), np.clip((x - self.mean) / self.scale, -8, 8)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(np.asarray(x, float)) @ self.weights, -30, 30)))
