"""Ranked search against scores of all documents."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrwatch.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, k):
    """Every document scored by the definition."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    rows = []
    for item, text in set(items):
        scored = []
        for (doc, c), size in zip(counts, sizes, strict=True):
            if size:
                m = 100 - 50 + (50 * size * n) // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                            for t in set(terms(text)) if c[t])
                if score > 0:
                    scored.append((-score, doc is None, doc or 0, doc))
        rows += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed, side", [(1, 3), (2, 64), (3, 100), (4, 257)])
def test_treap_gives_the_best_columns(seed, side):
    rng = np.random.default_rng(seed)
    grid = rng.integers(0, 6, (40, side)) * (rng.random((40, side)) < 0.3)
    row, column = np.nonzero(grid)
    treap = lexical.Treap(row, column, grid[row, column], max(40, side))
    for _ in range(20):
        own = np.unique(rng.integers(0, 40, 6))
        weights = rng.integers(1, 4, len(own))
        scores = weights @ grid[own]
        want = [c for c in np.lexsort((np.arange(side), -scores)) if scores[c] > 0][:9]
        columns, found = treap.best(own, weights, 9)
        assert columns.tolist() == want
        assert found.tolist() == scores[want].tolist()


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_search_ranks_like_all_scores(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(lexical, "PART_DOCUMENTS", 90)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ſ", "K", "naïve", "İx"]

    def text(n):
        return " ".join(x.upper() if rng.random() < 0.2 and x.isascii() else x for x in map(str, rng.choice(vocabulary, n)))

    docs = [(int(i), text(int(rng.integers(0, 30)))) for i in rng.permutation(400)]
    docs += [(500 + i, docs[0][1]) for i in range(70)]  # more equal scores than ranks
    items = [(f"i{j}", text(6) + ", -- " + text(2)) for j in range(12)]
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                         spark.createDataFrame(items, "item_id string, text string"), k=50, block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs, items, 50)


def test_odd_tables(spark):
    long = " ".join(f"t{i * i % 7919}" for i in range(50_000))
    docs = [(1, "One text"), (1, "one TEXT"), (None, "one text"), (2, None), (None, None), (3, ""), (4, " \n"), (5, long), (6, long + " one"), (7, "é é")]
    items = [("a", "text one"), ("a", "text one"), ("a", "t4 é"), ("b", None), (None, "one"), ("c", ""), ("d", "missing")]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(0) for c in ("item", "rank", "score", "n", "terms")})
    items_df = spark.createDataFrame(items, "item_id string, text string").withColumns({c: F.lit(0) for c in ("item", "doc_id")})
    got = sorted((tuple(r) for r in lexical.search(docs_df, items_df, k=3).collect()), key=str)
    assert got == expected(docs, items, 3)
    assert lexical.search(docs_df.where("false"), items_df).count() == 0
    assert lexical.search(docs_df, items_df.where("false")).count() == 0


def test_terms_with_equal_hashes_are_told_apart():
    import pyarrow as pa
    from addrwatch.llm import words

    vocabulary = lexical.Vocabulary([b"one", b"two", b"six"])
    vocabulary.hashes = np.full(3, vocabulary.hashes[0])
    found = words.read(pa.array(["two SIX none one"]))
    found.hashes[:] = vocabulary.hashes[0]
    assert [vocabulary.terms[i] if i >= 0 else None for i in vocabulary.numbers(found)] == [b"two", b"six", None, b"one"]
