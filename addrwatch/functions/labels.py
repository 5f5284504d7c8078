"""Label, class and risk expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from addrwatch import config


def binary_label(label: Column, null_label: str = "positive") -> Column:
    """0 for the benign label, 1 for any other.

    A missing label counts as positive, since only the benign label is negative;
    ``null_label="drop"`` leaves it null for ``drop_null_target`` to remove.
    """
    flag = F.when(label == config.BENIGN_LABEL, 0).otherwise(1).cast("int")
    return flag if null_label == "positive" else F.when(label.isNotNull(), flag)


def apply_threshold(probability: Column, threshold: float | Column) -> Column:
    """1 where the probability reaches the threshold, else 0."""
    return (probability >= threshold).cast("int")


def outcome_class(y: Column, prediction: Column) -> Column:
    """tp, fn, fp or tn; null where the label or the prediction is missing."""
    return (
        F.when((y == 1) & (prediction == 1), "tp")
        .when((y == 1) & (prediction == 0), "fn")
        .when((y == 0) & (prediction == 1), "fp")
        .when((y == 0) & (prediction == 0), "tn")
    )


def label_name(prediction: Column) -> Column:
    return F.when(prediction == 1, config.POSITIVE_LABEL).otherwise(config.BENIGN_LABEL)


def is_positive(prediction: Column) -> Column:
    return prediction == 1


def risk_level(prediction: Column, probability: Column) -> Column:
    """Risk level of a prediction; a negative one is always low."""
    very_high, high = config.VERY_HIGH_RISK, config.HIGH_RISK
    return (
        F.when(prediction != 1, config.LOW_RISK)
        .when(probability >= very_high[0], very_high[1])
        .when(probability >= high[0], high[1])
        .otherwise(config.MEDIUM_RISK)
    )


def request_id() -> Column:
    """Random id, drawn once where a request enters."""
    return F.uuid()


def drift_severity(psi: Column) -> Column:
    return (
        F.when(psi > config.DRIFT_CRITICAL, "critical")
        .when(psi > config.DRIFT_WARNING, "warning")
        .otherwise("none")
    )
