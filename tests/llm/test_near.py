"""Near-duplicate classes against all pairs, and the sampling itself."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from addrwatch.llm import near, tables


def test_agreement_is_the_weighted_similarity():
    rng = random.Random(0)
    words = [f"w{k}" for k in range(400)]
    a = [rng.choice(words) for _ in range(300)]
    b = a[:]
    for k in rng.sample(range(300), 12):
        b[k] = "new"
    idf = np.linspace(1, 5, 1 << near.TABLE_BITS)
    own = near.Weights(pa.array([" ".join(a), " ".join(b), ""]), idf)
    assert own.present.tolist() == [True, True, False]
    samples = own.samples(3000)
    assert abs((samples[0] == samples[1]).mean() - near.similarity(own.of(0), own.of(1))) < 0.03
    again = near.Weights(pa.array(["x y z", " ".join(b)]), idf).samples(3000)
    assert (again[1] == samples[1]).all()


def classes(texts, idf, threshold):
    own = near.Weights(pa.array(texts), idf)
    group = list(range(len(texts)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if own.present[i] and own.present[j] and near.similarity(own.of(i), own.of(j)) >= threshold:
            group[find(i)] = find(j)
    found = {}
    for i in range(len(texts)):
        found.setdefault(find(i), set()).add(i)
    return set(map(frozenset, found.values()))


@pytest.mark.parametrize("paired", [32, 2])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, paired):
    monkeypatch.setattr(near, "PAIRED", paired)
    monkeypatch.setattr(near, "GROUP", 3)
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for g in range(8):
        base = [f"g{g}x{rng.randrange(500)}" for _ in range(120)] + passage * (g % 2)
        for _ in range(6):
            own = base[:]
            for k in rng.sample(range(120), rng.choice([0, 1, 2, 3, 6])):
                own[k] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    texts += ["short one", "short one", "Short, one!", "", "", None, "other"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in near.near_duplicates(df).collect():
        got.setdefault(r["class_id"], set()).add(r["doc_id"])
    idf = near.inverse_frequencies(df)
    assert set(map(frozenset, got.values())) == classes(texts, idf, near.THRESHOLD)


def test_links_close_to_the_threshold_are_found_beside_a_common_passage(spark):
    rng = random.Random(11)
    passage = [f"p{k}" for k in range(80)]
    texts = []
    for g in range(150):
        base = [f"g{g}x{k}" for k in range(200)]
        other = base[:]
        for k in rng.sample(range(200), 5):
            other[k] = f"e{g}x{k}"
        texts += [" ".join(base + passage), " ".join(other + passage)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = near.Weights(pa.array(texts), near.inverse_frequencies(df))
    linked = {g for g in range(150) if near.similarity(own.of(2 * g), own.of(2 * g + 1)) >= near.THRESHOLD}
    close = {g for g in linked if near.similarity(own.of(2 * g), own.of(2 * g + 1)) < 0.86}
    assert len(close) > 20
    found = {}
    for r in near.near_duplicates(df).collect():
        found.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert all(len({d // 2 for d in group}) == 1 for group in found.values())  # a passage alone links nothing
    both = {min(group) // 2 for group in found.values() if len(group) == 2}
    assert both <= linked
    assert len(both & close) >= 0.9 * len(close)


def test_texts_at_the_threshold_share_a_prefix_shingle(spark):
    """Every pair of texts that is similar enough meets by its rarest shingles, whatever else they share."""
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(50)]
    texts = []
    for g in range(12):
        base = [f"g{g}x{rng.randrange(60)}" for _ in range(90)] + passage * (g % 3)
        for _ in range(5):
            own = base[:]
            for k in rng.sample(range(90), rng.choice([0, 1, 2, 3])):
                own[k] = f"e{rng.randrange(50)}"
            texts.append(" ".join(own))
    idf = near.inverse_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    buckets = near._by_prefix(rows.select("node"), rows, spark.sparkContext.broadcast(idf), near.THRESHOLD).collect()
    keys = {}
    for r in buckets:
        keys.setdefault(r["node"], set()).add(r["key"])
    own, n = near.Weights(pa.array(texts), idf), 0
    for i, j in itertools.combinations(range(len(texts)), 2):
        if near.similarity(own.of(i), own.of(j)) >= near.THRESHOLD:
            n += 1
            assert keys.get(i, set()) & keys.get(j, set())
    assert n > 20


def test_stored_texts_are_not_shuffled_by_joins(spark):
    own = tables.bucketed(spark.range(100).select(F.col("id").alias("node"), F.lit("x").alias("text")), "node", "bucket_test")
    plan = spark.range(50).select(F.col("id").alias("node")).join(own.hint("merge"), "node")
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Exchange hashpartitioning") <= 1
    assert sorted(r["node"] for r in plan.collect()) == list(range(50))


def test_repeated_rows_are_one_class(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (None, None), (None, None)]
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5
    assert len({r["class_id"] for r in got if r["text_bytes"]}) == 1
    assert len({r["class_id"] for r in got}) == 3


def test_blocks_find_the_pairs_that_single_comparisons_find(monkeypatch):
    monkeypatch.setattr(near, "COLUMNS", 7)
    rng = random.Random(5)
    texts = []
    for g in range(6):
        base = [f"g{g}x{rng.randrange(40)}" for _ in range(60)] + ["again"] * (9 * (g % 3))
        for _ in range(5):
            own = base[:]
            for k in rng.sample(range(60), rng.choice([0, 1, 2, 3])):
                own[k] = f"e{rng.randrange(50)}"
            texts.append(" ".join(own + ["again"] * rng.choice([0, 0, 4])))
    rng.shuffle(texts)
    idf = np.linspace(1, 5, 1 << near.TABLE_BITS)
    own = near.Weights(pa.array(texts), idf)
    every = {(i, j) for i, j in itertools.product(range(12), range(12, len(texts))) if near.similarity(own.of(i), own.of(j)) >= near.THRESHOLD}
    sides = near._shingles(pa.array(texts[:12]), idf), near._shingles(pa.array(texts[12:]), idf)
    a, b = near._similar(*sides, np.ones((12, len(texts) - 12), bool), near.THRESHOLD)
    assert set(zip(a.tolist(), (b + 12).tolist(), strict=True)) == every
    assert len(every) > 3
    a, _ = near._similar(*sides, np.zeros((12, len(texts) - 12), bool), near.THRESHOLD)
    assert not len(a)


def test_a_large_bucket_of_many_classes_takes_no_rounds_and_no_row_per_pair(spark, monkeypatch):
    """Texts around the threshold share rare shingles, but many aren't linked."""
    rng = random.Random(2)
    base = [f"w{k}" for k in range(100)]
    texts = []
    for _ in range(120):
        own = base[:]
        for k in rng.sample(range(100), 5):
            own[k] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    monkeypatch.setattr(near, "PAIRED", 4)
    monkeypatch.setattr(near, "BLOCK", 50)
    mixed, verified, looks, pairs = near._mixed, near._verified, [], []
    monkeypatch.setattr(near, "_mixed", lambda *a: looks.append(1) or mixed(*a))
    monkeypatch.setattr(near, "_verified", lambda p, *a: pairs.append(p.count()) or verified(p, *a))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in near.near_duplicates(df).collect():
        found.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert set(map(frozenset, found.values())) == classes(texts, near.inverse_frequencies(df), near.THRESHOLD)
    assert len(looks) <= 2
    assert sum(pairs) <= near.BANDS * len(texts)
