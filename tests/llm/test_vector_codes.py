"""Codes against a search through all entries."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrwatch.llm import vector_codes


def floors(v):
    return [(n * 1024) // d for n, d in map(float.as_integer_ratio, v)]


def expected(rows, parts=4, entries=256, rounds=4):
    """{position of the row: (code, error)} and the codebooks, entry by entry with Python's integers."""
    kept = [i for i, (_, v, _) in enumerate(rows) if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    whole = {i: floors(rows[i][1]) for i in kept}
    kept = [i for i in kept if len(whole[i]) == len(whole[kept[0]])]
    cuts = [(int(c[0]), int(c[-1]) + 1) if len(c) else (0, 0) for c in np.array_split(np.arange(len(whole[kept[0]])), parts)]
    books = [[whole[i][a:b] for i in kept[:entries]] for a, b in cuts]

    def nearest(book, x):
        return min((sum((p - q) ** 2 for p, q in zip(e, x, strict=True)), k) for k, e in enumerate(book))

    for last in range(rounds + 1):
        found = {i: [nearest(book, whole[i][a:b]) for book, (a, b) in zip(books, cuts, strict=True)] for i in kept}
        if last < rounds:
            for p, (a, b) in enumerate(cuts):
                for k in range(len(books[p])):
                    own = [whole[i][a:b] for i in kept if found[i][p][1] == k]
                    if own:
                        books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    coded = {i: ("".join(f"{k:02x}" for _, k in found[i]), sum(d for d, _ in found[i])) for i in kept}
    return coded, hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def compressed(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    coded, books = vector_codes.compress(df, **options)
    return sorted((tuple(r) for r in vector_codes.with_label_errors(coded).collect()), key=str), vector_codes.digest(books)


def check(spark, rows, **options):
    got, digest = compressed(spark, rows, **options)
    coded, want_digest = expected(rows, **options)
    sums = {}
    for i, (_, error) in coded.items():
        sums[rows[i][2]] = sums.get(rows[i][2], 0) + error
    want = [(rows[i][0], rows[i][2], code, min(e, vector_codes.LARGEST), min(sums[rows[i][2]], vector_codes.LARGEST)) for i, (code, e) in coded.items()]
    assert got == sorted(want, key=str)
    assert digest == want_digest


@pytest.mark.parametrize("scale, entries, d", [(1.0, 256, 16), (0.003, 40, 16), (3e5, 30, 8), (1e30, 12, 8), (0.2, 25, 10), (1.0, 6, 3)])
def test_codes_are_those_of_all_entries(spark, scale, entries, d):
    """Small scales bring ties, large ones integers beyond doubles and longs."""
    rng = np.random.default_rng(int(d + entries))
    centres = rng.normal(size=(9, d))
    rows = [(int(i), (scale * (centres[rng.integers(0, 9)] + 0.3 * rng.normal(size=d))).tolist(), int(rng.integers(0, 3)) or None)
            for i in rng.permutation(330)]
    check(spark, rows, entries=entries)


@pytest.mark.parametrize("kind", [np.float64, np.int64, object])
def test_tree_finds_the_nearest_entry_and_the_lowest_of_equals(kind):
    rng = np.random.default_rng(3)
    entries = np.concatenate((rng.integers(-4, 4, (120, 3)), rng.integers(-4, 4, (60, 3)) * 100, np.zeros((40, 3), int))).astype(kind)
    points = np.concatenate((rng.integers(-5, 5, (300, 3)), rng.integers(-500, 500, (300, 3)))).astype(kind)
    entry, square, taken = vector_codes.Gnat(entries).nearest(points)
    all_squares = ((points[:, None].astype(int) - entries[None].astype(int)) ** 2).sum(axis=2)
    assert entry.tolist() == all_squares.argmin(axis=1).tolist()
    assert square.astype(int).tolist() == all_squares.min(axis=1).tolist()
    assert taken < all_squares.size / 2  # whole subtrees are passed over


def test_equal_entries_make_no_endless_tree():
    entry, square, _ = vector_codes.Gnat(np.zeros((256, 4))).nearest(np.ones((3, 4)))
    assert entry.tolist() == [0, 0, 0] and square.tolist() == [4, 4, 4]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 2.0, 3.0, 4.0], 1), (5, [1.0, 2.0, 3.0, 4.0], 1), (2, [0.5, 0.5, 0.5, -0.5], None), (None, [9.0, 9.0, 9.0, 9.0], None), (1, None, 1),
            (3, [nan, 1.0, 1.0, 1.0], 2), (4, [inf, 1.0, 1.0, 1.0], 2), (6, [None, 1.0, 1.0, 1.0], 2), (7, [1.0, 2.0], 2), (8, [], 2), (9, [-0.0001, 0.0, 1e-9, -1e-9], 3)]
    check(spark, rows)
    check(spark, rows, entries=2)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(0) for c in ("v", "code", "error", "part", "_label")})
    assert vector_codes.with_label_errors(vector_codes.compress(df)[0]).count() == 5
    for empty in (df.where("false"), df.where("vec_id = 1"), df.where("vec_id = 8")):
        coded, books = vector_codes.compress(empty)
        assert [r["code"] for r in vector_codes.with_label_errors(coded).collect()] in ([], ["00000000"])
        assert vector_codes.digest(books)
