"""Settings shared by every module.

The first block holds fixed values: column lists, constants, labels and limits
that decide the results, kept together in their natural order. The second block
holds tunables that only decide how the work is spread over the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# --------------------------------------------------------------- fixed values

START_DATE = date(2011, 1, 1)
PARTITION_COL = "partition_date"
LABEL_COL = "label"
BENIGN_LABEL = "white"
POSITIVE_LABEL = "ransomware"
DATE_COL = "transaction_date"
TARGET = "is_ransomware"

LOAD_COLS = [
    "partition_date", "year", "day", "length", "weight", "count",
    "looped", "neighbors", "income", "label",
]
DROP_COLS = ["partition_date", "year", "day", "label"]
RAW_FEATURES = ["length", "weight", "count", "looped", "neighbors", "income"]

EPSILON = 1e-6
LOG_COLS = ["count", "neighbors", "income"]
FIRST_RATIOS = [
    ("looped", "count"), ("looped", "length"), ("income", "length"),
    ("income", "count"), ("neighbors", "length"), ("neighbors", "weight"),
    ("weight", "length"),
]
SECOND_RATIOS = [
    ("log_income", "log_neighbors"), ("weight", "log_neighbors"),
    ("weight", "length"), ("length", "log_neighbors"),
]
Z_SCORE_COLS = [
    "length", "log_count", "log_income", "log_neighbors", "neighbors_per_length",
]

SEED = 42
NEGATIVE_RATIO = 5.0
SPLIT_WEIGHTS = (0.8, 0.2)
MAX_RECORDS_PER_FILE = 100_000

DEFAULT_THRESHOLD = 0.5
MAX_ROUNDS = 100
TOP_TERMS = 5
TP_WEAKEST = "tp_weakest_5"
FN_STRONGEST = "fn_strongest_5"

VERY_HIGH_RISK = (0.9, "very high")
HIGH_RISK = (0.7, "high")
MEDIUM_RISK = "medium"
LOW_RISK = "low"

CONFIDENCE_BUCKETS = [0.1, 0.3, 0.5, 0.7, 0.9, 1.0]
TELEMETRY_ZONE = "+01:00"
DRIFT_SAMPLE = 100
DRIFT_EPSILON = 1e-6
DRIFT_WARNING = 0.1
DRIFT_CRITICAL = 0.2
DRIFT_PERIOD = "1 minute"

RUN_NAME_PATTERN = "%feature_eng_2"
STAGE_SUFFIXES = ["baseline", "feature_eng_1", "feature_eng_2"]

EVALUATION_SECONDS = 15


@dataclass(frozen=True)
class AlertRule:
    """One alert: ``value <comparison> threshold`` held for ``hold`` seconds, for the
    series of ``metric`` whose labels equal those in ``where``."""

    alert: str
    metric: str
    by: tuple[str, ...]
    comparison: str
    threshold: float
    window: int | None  # seconds a rate looks back; None reads a gauge
    severity: str
    hold: int = 60
    step: int = EVALUATION_SECONDS
    where: tuple[tuple[str, str], ...] = ()


ALERT_RULES = [
    AlertRule("HttpNon200ResponseCode", "http_errors", ("job", "instance"), ">", 0.0, 60, "error"),
    AlertRule("ApiRequestRateSpike", "http_requests", ("job", "instance"), ">", 5.0, 60, "warning"),
    AlertRule("HighMemoryUsage", "memory_usage_bytes", ("instance",), ">", 1e9, None, "warning"),
    AlertRule("ModelLoadingFailure", "model_load_seconds", ("instance",), ">", 30.0, None, "critical"),
    AlertRule("DataQualityIssuesDetected", "data_quality", ("quality_rule",), ">", 0.1, 300, "warning"),
    AlertRule("HighPSIDrift", "psi", ("target",), ">", 0.1, None, "warning"),
    AlertRule("CriticalPSIDrift", "psi", ("target",), ">", 0.2, None, "critical"),
    AlertRule("HighRansomwarePredictionRate", "predictions", ("label",), ">", 0.2, 300, "info",
              where=(("label", POSITIVE_LABEL),)),
    AlertRule("LowCacheHitRate", "hit_rate", (), "<", 50.0, None, "info"),
    AlertRule("HighConfidenceRansomwareSpike", "risk_levels", ("confidence_level",), ">", 0.2, 300, "warning",
              where=(("confidence_level", VERY_HIGH_RISK[1]),)),
]

# ------------------------------------------------------------------- tunables

# Ordered prefix sums are cut into ranges of about this many rows.
RANGE_ROWS = 200_000


def rule(alert: str) -> AlertRule:
    """The configured rule of that name."""
    return next(r for r in ALERT_RULES if r.alert == alert)
