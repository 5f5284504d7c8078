from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from addrwatch.operators import evaluate
from addrwatch.operators.prefix import running_totals


def scored(spark, ys, ps):
    return spark.createDataFrame([(y, float(p)) for y, p in zip(ys, ps)], "is_ransomware int, probability double")


@pytest.mark.parametrize("ys, ps, best", [
    ([0, 0, 1, 1], [.1, .2, .8, .9], .8),
    ([1, 0, 1, 1], [.1, .6, .4, .9], .9),
    ([1, 1], [.1, .6], math.inf),
    ([0, 0], [.1, .6], math.inf),
    ([1, 0], [.2, .9], math.inf),
])
def test_best_threshold(spark, ys, ps, best):
    assert evaluate.best_threshold(scored(spark, ys, ps)).first()["threshold"] == best


@pytest.mark.parametrize("threshold, accuracy", [(.5, 1.0), (.05, .5)])
def test_evaluate(spark, threshold, accuracy):
    row = evaluate.evaluate(scored(spark, [0, 1, 0, 1], [.1, .8, .3, .9]), threshold).first()
    assert (row["accuracy"], row["fn"], row["tp"]) == (accuracy, 0, 2)


def test_score_equal_to_threshold_is_positive(spark):
    row = evaluate.evaluate(scored(spark, [1, 1], [.5, .4]), .5).first()
    assert (row["tp"], row["fn"], row["fp"], row["tn"]) == (1, 1, 0, 0)


def outcomes(spark, rows, names):
    df = spark.createDataFrame(rows, "is_ransomware int, probability double, " + ", ".join(f"`{n}` double" for n in names))
    return evaluate.with_outcome(evaluate.with_prediction(df, .5))


def test_weakest_terms(spark):
    df = outcomes(spark, [(1, .9, 10.0, 2.0), (1, .1, -5.0, -20.0), (0, .1, 100.0, 100.0)], ["income", "count"])
    got = {(r["outcome"], r["rank"]): (r["term"], r["mean_value"]) for r in evaluate.weakest_terms(df, ["income", "count"]).collect()}
    assert got == {("tp", 1): ("count", 2.0), ("tp", 2): ("income", 10.0),
                   ("fn", 1): ("count", -20.0), ("fn", 2): ("income", -5.0)}


def test_weakest_terms_without_false_negatives(spark):
    names = ["income", "length", "count"]
    df = outcomes(spark, [(1, .9, 10.0, 10.0, 0.0), (1, .9, 30.0, 10.0, 0.0)], names)
    got = [(r["outcome"], r["term"], r["mean_value"]) for r in evaluate.weakest_terms(df, names).orderBy("rank").collect()]
    assert got == [("tp", "count", 0.0), ("tp", "length", 10.0), ("tp", "income", 20.0)]


def test_top_terms_keep_signs(spark):
    values = {"income": 10.0, "weight": -9.0, "count": 5.0, "neighbors": 4.0, "income & count": 3.0, "length": 0.1}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` double" for k in values))
    top = evaluate.top_terms_abs(df, list(values)).first()["top_terms"]
    assert [(t["term"], t["value"]) for t in top] == [(k, v) for k, v in values.items() if k != "length"]


def brute_curve(rows):
    pos, neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    return {
        t: (sum(y for y, p in rows if p >= t) / pos, sum(1 - y for y, p in rows if p >= t) / neg)
        for t in {p for _, p in rows}
    }


@pytest.mark.parametrize("parts", [1, 7])
def test_curve_matches_brute_force_with_a_hot_score(spark, parts):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), .25 if rng.random() < .4 else round(rng.random() ** 4, 3)) for _ in range(3000)]
    df = scored(spark, *zip(*rows)).repartition(parts)
    got = {r["threshold"]: (r["tpr"], r["fpr"]) for r in evaluate.roc_curve(df, rows_per_range=16).collect()}
    assert got.pop(math.inf) == (0.0, 0.0)
    want = brute_curve(rows)
    assert got.keys() == want.keys()
    for t, pair in want.items():
        assert got[t] == pytest.approx(pair)


@pytest.mark.parametrize("rows_per_range", [1, 7, 50, 1000])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_with_hot_order_value(spark, rows_per_range, descending):
    rng = random.Random(9)
    rows = [(i, 50 if rng.random() < .4 else rng.randint(0, 100), rng.randint(1, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, at long, v long").repartition(5)
    done = running_totals(df, F.col("at"), {"total": F.col("v"), "n": F.lit(1)}, tie=F.col("id"),
                          descending=descending, rows_per_range=rows_per_range)
    got = {r["id"]: (r["total"], r["n"]) for r in done.collect()}
    total, want = 0, {}
    for n, (i, _, v) in enumerate(sorted(rows, key=lambda r: (-r[1] if descending else r[1], r[0])), 1):
        total += v
        want[i] = (total, n)
    assert got == want


def test_rows_without_label_or_score_count_nowhere(spark):
    rows = spark.createDataFrame([(1, .9), (None, .9), (1, None), (0, .1), (0, .9)], "is_ransomware int, probability double")
    found = evaluate.evaluate(rows, .5).first().asDict()
    assert found == {"accuracy": pytest.approx(2 / 3), "tp": 1, "fn": 0, "fp": 1, "tn": 1}


def test_rows_without_an_order_are_left_out_of_running_totals(spark):
    rows = spark.createDataFrame([(2.0, 1), (None, 5), (float("nan"), 7), (1.0, 3)], "at double, n int")
    got = running_totals(rows, F.col("at"), {"total": F.col("n")}).select("at", "total").collect()
    assert sorted(map(tuple, got)) == [(1.0, 3), (2.0, 4)]


@pytest.mark.parametrize("rows_per_range", [1, 5, 40])
def test_running_totals_with_several_hot_values_of_different_sizes(spark, rows_per_range):
    orders = [1.0] * 300 + [2.0] * 40 + [3.0] * 90 + [5.0 + i for i in range(100)] + [4.0] * 3
    rows = [(o, (i * 37) % 533, i % 5) for i, o in enumerate(orders)]
    df = spark.createDataFrame(rows, "at double, id long, v long").repartition(4)
    got = running_totals(df, F.col("at"), {"total": F.col("v"), "n": F.lit(1)}, tie=F.col("id"), rows_per_range=rows_per_range)
    total, want = 0, []
    for k, (o, i, v) in enumerate(sorted(rows), 1):
        total += v
        want.append((o, i, total, k))
    assert sorted((r["at"], r["id"], r["total"], r["n"]) for r in got.collect()) == want


def test_running_totals_shuffle_their_rows_once_and_use_no_window_over_everything(spark):
    df = spark.range(1000).withColumn("v", F.rand(1))
    plan = running_totals(df, F.col("v"), {"n": F.lit(1)}, tie=F.col("id"), rows_per_range=20)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_block" in text and "windowspecdefinition(_range" in text
    assert text.count("windowspecdefinition(") == text.count("windowspecdefinition(_")


@pytest.mark.parametrize("shape", ["apart", "mixed", "one score", "null labels"])
@pytest.mark.parametrize("rows_per_range", [1, 40, 10_000])
def test_best_threshold_by_bounds_equals_the_whole_curve(spark, shape, rows_per_range):
    rng = random.Random(11)
    if shape == "apart":
        rows = [(y, (rng.gauss(1.5 * y, 1))) for y in (rng.randint(0, 1) for _ in range(4000))]
    elif shape == "mixed":
        rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(2000)]
    elif shape == "one score":
        rows = [(rng.randint(0, 1), .5) for _ in range(500)]
    else:
        rows = [(rng.choice([0, 1, None]), rng.choice([None, rng.random()])) for _ in range(1000)]
    df = spark.createDataFrame(rows, "is_ransomware int, probability double").repartition(5)
    curve = evaluate.roc_curve(df).collect()
    want = max((round((r["tpr"] or 0.0) - (r["fpr"] or 0.0), 9), r["threshold"]) for r in curve)
    row = evaluate.best_threshold(df, rows_per_range=rows_per_range).first()
    assert (row["j"], row["threshold"]) == want


def test_few_ranges_are_sorted_for_the_best_threshold(spark):
    rng = random.Random(12)
    df = scored(spark, *zip(*[(y, rng.gauss(2 * y, 1)) for y in (rng.randint(0, 1) for _ in range(20_000))]))
    _, ranges = evaluate.bounded_ranges(df, rows_per_range=100)
    assert ranges.count() > 150
    assert 1 <= evaluate.open_ranges(ranges).count() < 20
