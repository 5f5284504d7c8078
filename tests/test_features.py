from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from addrwatch import config
from addrwatch.functions import numeric
from addrwatch.operators import features
from addrwatch.operators.stats import collect_stats, fit_stats

EPS = 1e-6


def one(spark, **values):
    return spark.createDataFrame([tuple(float(v) for v in values.values())], ", ".join(f"{k} double" for k in values))


RAW = dict(count=10, neighbors=1, income=100, looped=5, length=2, weight=4)


@pytest.mark.parametrize("values", [RAW, {k: 0 for k in RAW}])
def test_first_pass(spark, values):
    row = features.first_pass(one(spark, **values)).first().asDict()
    for name in config.LOG_COLS:
        assert row[f"log_{name}"] == pytest.approx(math.log1p(values[name]))
        assert name not in row
    for top, bottom in config.FIRST_RATIOS:
        assert row[f"{top}_per_{bottom}"] == pytest.approx(values[top] / (values[bottom] + EPS))
    assert set(row) == set(features.FIRST_PASS_COLS)


def test_log_of_negatives_is_null(spark):
    row = features.log_features(one(spark, count=-1, neighbors=-0.5, income=-7)).first()
    assert row["log_count"] is None and row["log_income"] is None
    assert row["log_neighbors"] == pytest.approx(math.log(0.5))


def test_ratio_with_zero_sum_is_null(spark):
    df = one(spark, a=1, b=-EPS)
    assert df.select(numeric.ratio(F.col("a"), F.col("b"))).first()[0] is None


@pytest.mark.parametrize("lazy", [True, False])
def test_second_pass_uses_unscaled_ratios(spark, lazy):
    passed = features.first_pass(one(spark, **RAW))
    log_income = math.log1p(100)
    fitted = {"length": (2.0, 1.0), "log_income": (log_income, 1.0), "log_count": (0.0, 2.0),
              "log_neighbors": (0.0, 1.0), "neighbors_per_length": (1.0, 3.0)}
    stats = fitted
    if lazy:
        stats = spark.createDataFrame([(k, *v) for k, v in fitted.items()], "col string, mean double, std double")
    row = features.second_pass(passed, stats).first()
    assert row["length"] == 0 and row["log_income"] == pytest.approx(0)
    assert row["log_count"] == pytest.approx(math.log1p(10) / 2)
    assert row["neighbors_per_length"] == pytest.approx((1 / (2 + EPS) - 1) / 3)
    assert row["log_income_per_log_neighbors"] == pytest.approx(log_income / (math.log1p(1) + EPS))
    assert row["length_per_log_neighbors"] == pytest.approx(2 / (math.log1p(1) + EPS))


def test_fit_stats(spark):
    df = spark.createDataFrame([(-2.0, -2.0, 1.0), (0.0, 1.0, 1.0), (2.0, 4.0, 1.0)],
                               "log_count double, neighbors_per_length double, income double")
    fitted = collect_stats(fit_stats(df, ["log_count", "neighbors_per_length"]))
    assert fitted["log_count"] == (0.0, 2.0)
    assert fitted["neighbors_per_length"] == (1.0, 3.0)
    assert "income" not in fitted


def test_one_row_fit_divides_by_one(spark):
    row = features.transform(one(spark, **RAW)).first()
    assert row["length"] == 0 and row["log_count"] == 0


def test_transform_fits_on_first_use(spark):
    data = [(10.0, 1.0, 100.0, 1.0, 2.0, 1.0), (20.0, 2.0, 200.0, 5.0, 4.0, 1.0), (30.0, 3.0, 300.0, 1.0, 6.0, 1.0)]
    df = spark.createDataFrame(data, "count double, neighbors double, income double, looped double, length double, weight double")
    rows = features.transform(df).orderBy("log_count").collect()
    logs = [math.log1p(v) for v in (10, 20, 30)]
    mean = sum(logs) / 3
    std = math.sqrt(sum((v - mean) ** 2 for v in logs) / 2)
    assert [r["log_count"] for r in rows] == pytest.approx([(v - mean) / std for v in logs])
    assert [r["looped_per_count"] for r in rows] == pytest.approx([1 / (10 + EPS), 5 / (20 + EPS), 1 / (30 + EPS)])


def test_absent_columns_are_skipped(spark):
    row = features.z_score(one(spark, length=3), {"length": (1.0, 2.0), "log_count": (0.0, 1.0)}).first()
    assert row.asDict() == {"length": 1.0}


def test_step_value_matches_a_scan(spark):
    bounds = [-1.0, 0.0, 0.5, 2.0, 7.0]
    values = [10, 11, 12, 13, 14, 15]
    xs = [-9.0, -1.0, -0.5, 0.0, 0.4, 0.5, 1.9, 2.0, 6.9, 7.0, 99.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(numeric.step_value(F.col("x"), bounds, values)).collect()]
    assert got == [values[sum(b <= x for b in bounds)] for x in xs]
