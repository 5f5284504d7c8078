"""Repeated strings against counting all of them."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from addrwatch.llm import bwt, repeats


def plain(texts: list[str | None], length: int) -> list[tuple[bytes, list[tuple[int, int]]]]:
    data = [(t or "").encode() for t in texts]
    counts = Counter(x[i : i + length] for x in data for i in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if counts[x[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
        out.append((bytes(b for b, g in zip(x, gone, strict=True) if not g), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))))
    return out


def test_interval_expansion_finds_all_repeats():
    rng = np.random.default_rng(0)
    for _ in range(150):
        length = int(rng.integers(2, 9))
        strings = [rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(0, 60))).astype(np.uint8) for _ in range(int(rng.integers(1, 8)))]
        weights = rng.integers(1, 3, len(strings))
        counts = Counter()
        for s, w in zip(strings, weights, strict=True):
            for i in range(len(s) - length + 1):
                counts[s[i : i + length].tobytes()] += int(w)
        for s, got in zip(strings, bwt.repeated_starts(strings, weights, length), strict=True):
            assert got.tolist() == [counts[s[i : i + length].tobytes()] > 1 for i in range(len(s) - length + 1)]


@pytest.mark.parametrize("hot_contexts, group_bytes", [(2000, 1 << 20), (1, 64)])
def test_removed_bytes_are_those_of_all_strings(spark, monkeypatch, hot_contexts, group_bytes):
    monkeypatch.setattr(repeats, "RUN", 90)  # longer texts go through in stretches
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdeé") for _ in range(n))
    common = [text(30) for _ in range(4)]
    texts = ["".join(rng.choice([text(rng.randrange(1, 25)), rng.choice(common)]) for _ in range(rng.randrange(0, 9))) for _ in range(40)]
    texts += [None, "", "a" * 70, "ab" * 50, texts[3], texts[3], text(400), common[0] * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = repeats.repeats(df, length=12, gram=5, hot_contexts=hot_contexts, group_bytes=group_bytes).collect()
    assert len(got) == len(texts)
    want = plain(texts, 12)
    for r in got:
        assert (bytes(r["kept"]), [tuple(s) for s in r["spans"]]) == want[r["doc_id"]]
        assert r["n_bytes"] == len((texts[r["doc_id"]] or "").encode())


def test_a_gram_longer_than_the_string_is_refused(spark):
    with pytest.raises(ValueError):
        repeats.repeats(spark.createDataFrame([], "doc_id long, text string"), length=8, gram=9)
