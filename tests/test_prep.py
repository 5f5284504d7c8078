from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from addrwatch import config, views
from addrwatch.operators import prep
from addrwatch.operators.stats import class_counts, training_baseline
from addrwatch.plans.prepare import preprocess
from addrwatch.sources import activity

RAW = "address string, year int, day int, length long, weight double, count long, looped long, neighbors long, income double, label string"


def raw(spark, *rows):
    full = [(f"a{i}", year, day, 1, 0.5, 2, 0, 3, 10.0, label) for i, (year, day, label) in enumerate(rows)]
    return spark.createDataFrame(full, RAW)


@pytest.mark.parametrize("start, days, kept", [
    (date(2021, 1, 1), [(2020, 365), (2021, 1), (2021, 1)], 2),
    (date(2021, 2, 19), [(2021, 49), (2021, 50)], 1),
])
def test_read_since_is_inclusive(spark, tmp_path, start, days, kept):
    path = str(tmp_path / "set")
    activity.write_activity(raw(spark, *[(y, d, "white") for y, d in days]), path)
    read = activity.read_activity_since(spark, path, start)
    assert read.count() == kept
    assert read.columns == config.LOAD_COLS
    assert dict(read.dtypes)["partition_date"] == "date"


@pytest.mark.parametrize("rows, expected", [
    ([(2021, 5, "white"), (2021, 6, "wannacry")], [0, 1]),
    ([(2020, 32, "cryptolocker"), (2020, 366, "white")], [0, 1]),
    ([(2020, 32, None), (2021, 366, "white")], [0, 1]),
])
def test_preprocess_labels(spark, tmp_path, rows, expected):
    path = str(tmp_path / "set")
    activity.write_activity(raw(spark, *rows), path)
    done = preprocess(spark, path, date(2011, 1, 1), keep_key=False)
    assert set(done.columns) == {*config.RAW_FEATURES, config.TARGET}
    assert sorted(r[config.TARGET] for r in done.collect()) == expected


def test_null_label_can_be_dropped(spark, tmp_path):
    path = str(tmp_path / "set")
    activity.write_activity(raw(spark, (2020, 3, None), (2020, 4, "white")), path)
    assert preprocess(spark, path, date(2011, 1, 1), null_label="drop").count() == 1


def test_short_year_rolls_over_on_ingest(spark):
    dated = prep.with_transaction_date(prep.with_partition_date(raw(spark, (2021, 366, "white")))).first()
    assert dated["partition_date"] == date(2022, 1, 1)
    assert dated["transaction_date"] is None


def sampled(spark, positives, negatives, ratio):
    rows = [(f"p{i}", date(2020, 1, 1), 1) for i in range(positives)]
    rows += [(f"n{i}", date(2020, 1, 1), 0) for i in range(negatives)]
    df = spark.createDataFrame(rows, "address string, partition_date date, is_ransomware int")
    return df, prep.downsample(prep.by_class(df, 0), class_counts(df), ratio)


def test_downsample_is_near_its_ratio(spark):
    _, kept = sampled(spark, 400, 8000, 5.0)
    assert abs(kept.count() - 2000) < 150


@pytest.mark.parametrize("positives, negatives, ratio, kept", [(2, 0, 1.0, 0), (0, 5, 5.0, 0), (5, 4, 5.0, 4)])
def test_downsample_edges(spark, positives, negatives, ratio, kept):
    assert sampled(spark, positives, negatives, ratio)[1].count() == kept


def test_small_downsample_is_a_fixed_subset(spark):
    df, kept = sampled(spark, 2, 5, 1.0)
    again = prep.downsample(prep.by_class(df.repartition(3), 0), class_counts(df), 1.0)
    assert sorted(kept.collect()) == sorted(again.collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_split_does_not_depend_on_layout(spark, sf, parts):
    rows = views.labelled(spark, sf)
    first = {(r["address"], r["split"]) for r in prep.split_data(rows).collect()}
    again = {(r["address"], r["split"]) for r in prep.split_data(rows.repartition(parts)).collect()}
    assert first == again


def test_split_keeps_every_sampled_row(spark, sf):
    rows = views.labelled(spark, sf)
    kept = prep.downsample(prep.by_class(rows, 0), class_counts(rows)).count()
    split = prep.split_data(rows)
    assert split.count() == kept + prep.by_class(rows, 1).count()
    train = split.filter(F.col("split") == "train")
    counts = {r["value"]: r["n"] for r in training_baseline(train).collect()}
    assert counts[True] + counts[False] == train.count()
    assert 0.7 < train.count() / split.count() < 0.9


def test_one_pass_split_equals_the_parts(spark, sf):
    rows = views.labelled(spark, sf)
    kept = prep.downsample(prep.by_class(rows, 0), class_counts(rows))
    parts = prep.union_splits(prep.stratified_split(prep.by_class(rows, 1)), prep.stratified_split(kept))
    assert sorted(parts.collect()) == sorted(prep.split_data(rows).select(parts.columns).collect())
