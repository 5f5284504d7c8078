from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from addrwatch.operators import lookups
from addrwatch.operators.skew import heavy_keys, salt_keys

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def frames(spark, asked, given):
    a = spark.createDataFrame([(i, at(t), k) for i, t, k in asked], "lookup_id long, ts timestamp_ntz, request_id string")
    g = spark.createDataFrame([(k, at(t)) for k, t in given], "request_id string, ts timestamp_ntz")
    return a, g


def brute(asked, given):
    open_at, hits = dict(given), {}
    for i, t, k in sorted(asked, key=lambda r: (r[1], r[0])):
        hits[i] = k in open_at and open_at[k] <= t
        if hits[i]:
            del open_at[k]
    return hits


def test_second_and_unknown_lookups_miss(spark):
    asked = [(1, 5, "x"), (2, 6, "x"), (3, 7, "y"), (4, 1, "x")]
    marked = lookups.explain_lookup(*frames(spark, asked, [("x", 3)]))
    assert {r["lookup_id"]: r["hit"] for r in marked.collect()} == {1: True, 2: False, 3: False, 4: False}
    rate = lookups.lookup_hit_rate(marked).first()
    assert (rate["hits"], rate["misses"], rate["hit_rate"]) == (1, 3, 25.0)


@pytest.mark.parametrize("parts", [1, 7])
def test_hot_request_matches_brute_force(spark, parts):
    rng = random.Random(3)
    given = [(f"r{i}", rng.randint(0, 1000)) for i in range(300)]
    asked = [(i, rng.randint(0, 1000), "r7" if rng.random() < .4 else f"r{rng.randint(0, 400)}") for i in range(2000)]
    a, g = frames(spark, asked, given)
    assert "r7" in {r["_heavy"] for r in heavy_keys(a, "request_id").collect()}
    marked = lookups.explain_lookup(a.repartition(parts), g)
    assert {r["lookup_id"]: r["hit"] for r in marked.collect()} == brute(asked, given)
    known = {k for k, _ in given}
    missed = {r["lookup_id"] for r in lookups.lookup_misses(a.repartition(parts), g).collect()}
    assert missed == {i for i, _, k in asked if k not in known}


def test_running_rate_with_equal_times(spark):
    rng = random.Random(4)
    rows = [(i, at(50 if rng.random() < .5 else rng.randint(0, 100)), rng.random() < .3) for i in range(500)]
    df = spark.createDataFrame(rows, "lookup_id long, ts timestamp_ntz, hit boolean")
    got = {r["lookup_id"]: (r["hits"], r["seen"]) for r in lookups.running_hit_rate(df, rows_per_range=8).collect()}
    hits, want = 0, {}
    for n, (i, _, hit) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1):
        hits += hit
        want[i] = (hits, n)
    assert got == want


def test_salts_follow_the_size_of_a_partition(spark):
    rng = random.Random(8)
    keys = [None] * 10_000 + ["hot"] * 3_000 + ["warm"] * 50 + [f"k{rng.randint(0, 4000)}" for _ in range(6_950)]
    rng.shuffle(keys)
    a, g = frames(spark, [(i, 5, k) for i, k in enumerate(keys)], [(k, 1) for k in {"hot", "warm", "k1", "none"}])
    salts = {r["_heavy"]: r["_salts"] for r in heavy_keys(a, "request_id", 400).collect()}
    assert salts == {"hot": 120, "warm": 2}
    assert {r["_heavy"] for r in heavy_keys(a, "request_id", 8).collect()} == {"hot"}
    asked, given = salt_keys(a, g, "request_id", "lookup_id", 400)
    sizes = asked.filter("request_id = 'hot'").groupBy("_salt").count().collect()
    assert len(sizes) == 120 and max(r["count"] for r in sizes) < 3 * 25
    assert given.count() == 120 + 2 + 1 + 1
    marked = lookups.explain_lookup(a, g)
    assert {r["request_id"] for r in marked.filter("hit").collect()} == {"hot", "warm"} | ({"k1"} & set(keys))
    assert marked.count() == len(keys) and marked.filter("request_id IS NULL AND NOT hit").count() == 10_000
    assert lookups.lookup_misses(a, g).filter("request_id IS NULL").count() == 10_000
    plan = lookups.lookup_misses(a, g)._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(request_id" in plan
