from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from addrwatch import config
from addrwatch.catalog.fixed_model import FIXED
from addrwatch.operators import additive
from addrwatch.sources import tables


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(3000):
        a, b, c = rng.gauss(0, 1), rng.random(), rng.gauss(0, 1)
        raw = 2.5 * (abs(a) > 1) + 3 * ((b > .5) == (c > 0)) - 3
        data.append((i, None if i % 50 == 0 else a, b, c, int(rng.random() < 1 / (1 + math.exp(-raw)))))
    return spark.createDataFrame(data, "id long, a double, b double, c double, is_ransomware int")


def auc(df):
    ready = df.select(F.col("probability").alias("rawPrediction"), F.col("is_ransomware").alias("label"))
    return BinaryClassificationEvaluator().evaluate(ready)


def test_fit_finds_a_curved_effect_and_pairs_help(spark, rows):
    plain = additive.fit_additive(rows, ["a", "b", "c"])
    paired = additive.fit_additive(rows, ["a", "b", "c"], pairs=[("b", "c")])
    assert paired.term_names == ["a", "b", "c", "b & c"]
    assert auc(additive.explain(rows, plain)) > .6
    assert auc(additive.explain(rows, paired)) > auc(additive.explain(rows, plain)) + .1


def test_scores_add_up(spark, rows):
    model = additive.fit_additive(rows, ["a", "b"], bins=4).with_threshold(.4)
    done = additive.predict(rows, model).collect()
    for r in done[:200]:
        total = model.intercept + sum(r["terms"])
        assert r["probability"] == pytest.approx(1 / (1 + math.exp(-total)))
        assert r["prediction"] == int(r["probability"] >= .4)
    missing = {r["terms"]["a"] for r in done if r["a"] is None}
    assert missing == {model.terms[0].scores[-1]}
    assert all(r["probability"] is not None for r in done)


def test_bins_match_a_scan(spark, rows):
    term = FIXED.terms[0]
    df = spark.createDataFrame([(x,) for x in (-9.0, -.55, 0.0, .45, 2.0, None, float("nan"))], "length double")
    assert [r[0] for r in df.select(term.column()).collect()] == [-.42, .11, .11, .63, .63, .02, .02]


def test_model_survives_its_tables(spark, rows, tmp_path):
    model = additive.fit_additive(rows, ["a", "b", "c"], pairs=[("b", "c")]).with_threshold(.3)
    tables.save_model(spark, model, str(tmp_path / "m"))
    loaded = tables.load_model(spark, str(tmp_path / "m"))
    assert loaded.threshold == .3 and set(loaded.term_names) == set(model.term_names)
    first = {r["id"]: r["probability"] for r in additive.explain(rows, model).collect()}
    again = {r["id"]: r["probability"] for r in additive.explain(rows, loaded).collect()}
    assert all(first[i] == pytest.approx(again[i]) for i in first)


@pytest.mark.parametrize("model", [None, additive.AdditiveModel((), 0.0)])
def test_untrained_model_is_refused(rows, model):
    for use in (additive.explain, additive.predict, additive.term_scores):
        with pytest.raises(RuntimeError, match="not trained"):
            use(rows, model)


def test_attribution_map(spark):
    df = spark.createDataFrame([(0.0,) * 6], ", ".join(
        f"{c} double" for c in ("length", "log_income", "neighbors_per_length", "weight", "looped_per_count", "income_per_count")))
    got = additive.term_scores(df, FIXED).select(additive.attribution_map(FIXED)).first()[0]
    assert set(got) == set(FIXED.term_names)
    assert got["length & weight"] == -.09 and got["length"] == .11


def test_fixed_lists():
    assert config.RAW_FEATURES == ["length", "weight", "count", "looped", "neighbors", "income"]


def test_missing_side_of_a_pair_is_fitted_and_an_unnamed_pair_is_found(spark):
    rng = random.Random(5)
    data = []
    for _ in range(4000):
        a, b, c = (rng.random() for _ in range(3))
        gone = rng.random() < .2
        y = int(rng.random() < (.9 if gone else .85 if (a > .5) != (b > .5) else .15))
        data.append((None if gone else a, b, c, y))
    rows = spark.createDataFrame(data, "a double, b double, c double, is_ransomware int").cache()
    plain = additive.fit_additive(rows, ["a", "b", "c"])
    assert additive.strongest_pairs(rows, plain, ["a", "b", "c"], 1) == [("a", "b")]
    paired = additive.fit_additive(rows, ["a", "b", "c"], pairs=[("a", "b")])
    bare = additive.explain(rows, paired).filter("a IS NULL")
    got = bare.agg(F.avg("probability").alias("p"), F.avg("is_ransomware").alias("y")).first()
    assert abs(got["p"] - got["y"]) < .01
    assert auc(additive.explain(rows, paired)) > auc(additive.explain(rows, plain)) + .1


def test_cells_of_pairs_are_summed_without_a_row_for_each(spark, capsys):
    data = [(None if i % 11 == 0 else i % 7 / 8 - .4, i % 5 / 16, i % 3, i % 4, float(i % 6) if i % 13 else None, i) for i in range(3000)]
    frame = spark.createDataFrame(data, "_rest double, _spread double, a int, b int, c double, i int").withColumn(
        "c", F.coalesce("c", F.lit(6)).cast("int")).repartition(5).drop("i")
    got = additive._cell_sums(frame, ["a", "b", "c"], 7)
    got.explain()
    assert "Generate" not in capsys.readouterr().out
    cells = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), (F.col(x) * 7.0 + F.col(y)).alias("cell")) for x, y in ("ab", "ac", "bc")])
    plain = frame.select("_rest", "_spread", F.inline(cells)).groupBy("a", "b", "cell").agg(F.sum("_rest").alias("rest"), F.sum("_spread").alias("spread"))
    one, two = ({(r["a"], r["b"], r["cell"]): (r["rest"], r["spread"]) for r in df.collect()} for df in (got, plain))
    assert one.keys() == two.keys() and len(one) == 37
    assert all(one[k] == pytest.approx(two[k], abs=1e-9) for k in one)
