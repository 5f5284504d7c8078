"""Packing plans against brute force and bounds, and places of real pieces."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from addrwatch.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def fewest(items: tuple[int, ...], capacity: int) -> int:
    """Fewest sequences, by trying all."""
    best = len(items)

    def put(i: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in {r: n for n, r in enumerate(rooms)}.values():
            if rooms[k] >= items[i]:
                put(i + 1, [r - items[i] * (n == k) for n, r in enumerate(rooms)])
        put(i + 1, [*rooms, capacity - items[i]])

    put(0, [])
    return best


def used(patterns: list[packing.Pattern]) -> Counter:
    out = Counter()
    for p in patterns:
        for length, copies in p.parts:
            out[length] += p.sequences * copies
    return out


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_the_optimum(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(6, 20))
    items = tuple(sorted(rng.integers(1, capacity + 1, int(rng.integers(1, 9))).tolist(), reverse=True))
    counts = np.bincount(items, minlength=capacity + 1)
    fixed = packing.reduce_counts(counts)
    rest = tuple(itertools.chain.from_iterable([k] * n for k, n in enumerate(counts.tolist())))[::-1]
    assert sum(p.sequences for p in fixed) + fewest(rest, capacity) == fewest(items, capacity)
    assert used(fixed) + Counter(rest) == Counter(items)


@pytest.mark.parametrize("seed", range(10))
def test_plan_places_every_item_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 300))
    lengths = np.minimum(rng.geometric(8 / capacity, 3000), capacity)
    counts = Counter(lengths.tolist())
    plan = packing.plan(counts, capacity)
    assert used(plan) == counts
    assert all(sum(a * b for a, b in p.parts) <= capacity for p in plan)
    n = sum(p.sequences for p in plan)
    assert -(-int(lengths.sum()) // capacity) <= n <= -(-int(lengths.sum()) // capacity) * 1.02 + 1


def test_lengths_outside_the_capacity_are_refused():
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)


def test_pieces_fill_sequences_without_gaps(spark):
    texts = {1: "Hello, World! it's 42", 2: None, 3: "", 4: "a b " * 40, 5: "a b " * 40, 6: "x y\n\n  Ź ÀÉ"}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()] + [(None, "n")], "doc_id long, text string")
    pieces = packing.token_pieces(docs, PATH, capacity=16)
    placed = packing.pack(pieces.select("row", "doc_id", "piece", "start", "length"), capacity=16, group_rows=2)
    rows = placed.collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 16
    own = {r["row"]: r for r in pieces.collect()}
    tokenizer = Tokenizer.from_file(PATH)
    for doc, text in texts.items():
        found = sorted((r["piece"], r["start"], bytes(own[r["row"]]["ids"])) for r in rows if r["doc_id"] == doc)
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert [f[1] for f in found] == list(range(0, len(ids), 16))
        assert b"".join(f[2] for f in found) == np.array(ids, "<u4").tobytes()
    whole = packing.sequences(pieces, placed).collect()
    assert {s["sequence_id"] for s in whole} == set(by_sequence)
    assert all(s["length"] * 4 == len(s["ids"]) for s in whole)
    first = next(s for s in whole if s["sequence_id"] == rows[0]["sequence_id"])
    at = 4 * rows[0]["offset"]
    assert zlib.crc32(bytes(first["ids"])[at : at + 4 * rows[0]["length"]]) == zlib.crc32(bytes(own[rows[0]["row"]]["ids"]))
