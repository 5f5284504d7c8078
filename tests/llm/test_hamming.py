"""Nearest codes against all distances."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrwatch.llm import hamming


@pytest.mark.parametrize("bits, rows, k, clustered", [(64, 400, 10, False), (20, 300, 5, True), (7, 90, 12, False), (128, 200, 3, True)])
def test_nearest_are_those_of_all_distances(spark, bits, rows, k, clustered):
    rng = np.random.default_rng(bits)
    vectors = rng.normal(size=(rows, bits))
    if clustered:
        vectors += 2 * rng.normal(size=(5, bits))[rng.integers(0, 5, rows)]
    data = [(i, v.tolist()) for i, v in enumerate(vectors)]
    codes = hamming.sign_codes(spark.createDataFrame(data, "vec_id long, embedding array<double>"), bits)
    got = {}
    for r in hamming.nearest(codes, F.col("id") % 20 == 0, k, bits, part_rows=70, block_queries=6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["distance"], r["neighbor_id"]))
    signs = vectors > 0
    assert set(got) == set(range(0, rows, 20))
    for q, found in got.items():
        distance = (signs != signs[q]).sum(axis=1)
        want = sorted((int(d), i) for i, d in enumerate(distance) if i != q)[:k]
        assert [(d, i) for _, d, i in sorted(found)] == want


def test_odd_rows(spark):
    rows = [(0, [1.0, -1.0]), (1, [1.0, None]), (1, [1.0, float("nan")]), (2, None), (None, [1.0, 1.0]), (3, [1.0]), (20, [-1.0, -1.0])]
    codes = hamming.sign_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2)
    got = sorted(map(tuple, hamming.nearest(codes, F.col("id") % 20 == 0, 5, 2).collect()))
    assert got == [(0, 1, 1, 0), (0, 2, 1, 0), (0, 3, 20, 1), (20, 1, 0, 1), (20, 2, 1, 1), (20, 3, 1, 1)]
    none = codes.where("false")
    assert hamming.nearest(none, F.col("id") % 20 == 0, 5, 2).count() == 0
