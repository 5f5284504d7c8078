"""Linked vectors against all cosines."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrwatch.llm import vector_links


def expected(rows, threshold):
    """(vec_id, n_links, component_id, kept) by comparing all rows."""
    fit = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    units = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in fit}
    near = {i: [j for j in fit if j != i and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold] for i in fit}
    out, component = [], {}
    for i in range(len(rows)):
        if i not in component:
            seen, stack = {i}, [i]
            while stack:
                new = set(near.get(stack.pop(), [])) - seen
                seen |= new
                stack += new
            ids = [rows[j][0] for j in seen if rows[j][0] is not None]
            component |= dict.fromkeys(seen, min(ids) if ids else None)
        own, least = rows[i][0], component[i]
        out.append((own, len(near.get(i, [])), least, None if own is None or least is None else own == least))
    return sorted(out, key=str)


def found(spark, rows, threshold=0.95, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return sorted((tuple(r) for r in vector_links.near_vectors(df, threshold).collect()), key=str)


def clustered(rng, n, d, centres, spread):
    middle = rng.normal(size=(centres, d))
    middle /= np.linalg.norm(middle, axis=1)[:, None]
    return middle[rng.integers(0, centres, n)] + rng.normal(size=(n, d)) * spread * rng.random((n, 1)) / np.sqrt(d)


@pytest.mark.parametrize("d, threshold, leaf, chunk", [(64, 0.95, 20, 1 << 20), (64, 0.95, 1 << 20, 40), (64, 0.8, 30, 25), (5, 0.95, 20, 50), (1, 0.95, 9, 9), (48, 0.9, 10, 30)])
def test_links_are_those_of_all_cosines(spark, monkeypatch, d, threshold, leaf, chunk):
    monkeypatch.setattr(vector_links, "LEAF_ROWS", leaf)
    monkeypatch.setattr(vector_links, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(vector_links, "SAMPLED_PER_LEAF", 8)
    rng = np.random.default_rng(d)
    vectors = np.concatenate((clustered(rng, 250, d, 12, 0.5), clustered(rng, 120, d, 1, 0.4), rng.normal(size=(80, d))))
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [(2000, [2 * x for x in rows[5][1]])]
    want = expected(rows, threshold)
    assert found(spark, rows, threshold) == want
    assert sum(r[1] for r in want) > 100


def test_pairs_at_the_threshold_of_single_numbers(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 64)).astype(np.float32)
    other = rng.normal(size=(40, 64)).astype(np.float32)
    base /= np.linalg.norm(base, axis=1)[:, None]
    other -= base * (base * other).sum(axis=1)[:, None]
    other /= np.linalg.norm(other, axis=1)[:, None]
    cosine = 0.95 + np.linspace(-1e-4, 1e-4, 40)[:, None]
    near = (base * cosine + other * np.sqrt(1 - cosine**2)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate((base, near)))]
    got = found(spark, rows, kind="float")
    assert got == expected(rows, 0.95)
    assert 30 < sum(r[1] for r in got) < 50


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, [0.99, 0.0]), (None, [0.0, 1.0]), (3, None), (3, None), (4, []), (5, [0.0, 0.0]),
            (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, -0.0]), (11, [-1.0, 0.0]), (12, [1e300, 1e300]), (13, [1e-300, 1e-300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "v", "mark", "node", "n_links")})
    got = sorted((tuple(r) for r in vector_links.near_vectors(df).collect()), key=str)
    assert got == expected([(i, None if v is None else [x / 1e300 if x == 1e300 else x * 1e300 if x == 1e-300 else x for x in v] if None not in v else v) for i, v in rows], 0.95)
    assert vector_links.near_vectors(df.where("false")).count() == 0
