"""Repeats of a set length among byte strings, by interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least, by prefix doubling.

    Each round orders only the suffixes that the rounds before left equal to another.
    """
    n = len(symbols)
    width = int(symbols.max()).bit_length() + 1 if n else 1
    span = max(1, 62 // width)
    padded = np.concatenate((symbols.astype(np.int64) + 1, np.zeros(span, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(span):
        key = key << width | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    sorted_keys = key[order]
    new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])) if n else np.zeros(0, bool)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    starts = np.flatnonzero(new)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    while span < depth:
        same = ~new
        same[:-1] |= ~new[1:]
        open_at = np.flatnonzero(same)
        if not len(open_at):
            break
        own = order[open_at]
        # Rank first, then the rank of the suffix that follows the part already compared.
        second = rank[np.minimum(own + span, n)] + 1
        place = np.lexsort((second, rank[own])) if n >= 1 << 31 else np.argsort(rank[own] << 32 | second, kind="stable")
        own, second = own[place], second[place]
        order[open_at] = own
        first = rank[own]
        differs = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        new[open_at] = differs
        heads = open_at[differs]
        rank[own] = np.repeat(heads, np.diff(np.append(np.flatnonzero(differs), len(own))))
        span *= 2
    return order


def long_prefix_runs(symbols: np.ndarray, order: np.ndarray, separators: int, length: int) -> np.ndarray:
    """Where, among ordered suffixes, the common prefix with the one before is shorter than ``length``.

    Symbols below ``separators`` each occur once. Level 0 has an interval of suffixes for each
    first symbol. Level v + 1 comes from the intervals [b, r) of level v, each of which begins at a
    boundary of value v: for every c that precedes one of its suffixes, backward extension
    leads to an interval among the suffixes that start with c; where it begins, the common
    prefix is v + 1 long unless a smaller value was found there before. Whole levels are taken
    at once, and none after length - 1: what is left has longer common prefixes.
    """
    n = len(symbols)
    bwt = symbols[order - 1]  # the first suffix is preceded by the last symbol
    letters = np.flatnonzero(np.bincount(symbols))
    letters = letters[letters >= separators]
    code = np.zeros(int(symbols.max()) + 1, np.int16)
    code[letters] = np.arange(1, len(letters) + 1)
    coded = code[bwt]
    by_letter = np.argsort(coded, kind="stable").astype(np.int32)
    # Where backward extension leads, and the nearest suffixes with the same symbol before them.
    leads = np.empty(n, np.int32)
    leads[by_letter] = np.arange(n, dtype=np.int32)
    before, after = np.full(n, -1, np.int32), np.full(n, n, np.int32)
    same = coded[by_letter[1:]] == coded[by_letter[:-1]]
    before[by_letter[1:][same]] = by_letter[:-1][same]
    after[by_letter[:-1][same]] = by_letter[1:][same]
    inside = coded > 0
    short = np.zeros(n, bool)
    short[:separators] = True
    counts = np.bincount(code[symbols], minlength=len(letters) + 1)[1:]
    right = separators + np.cumsum(counts)
    left = right - counts
    short[left] = True
    for _ in range(1, length):
        if not len(left):
            break
        sizes = right - left
        starts = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum(), dtype=np.int32) + np.repeat((left - starts).astype(np.int32), sizes)
        at_inside = inside[at]
        first = at[(before[at] < np.repeat(left.astype(np.int32), sizes)) & at_inside]
        last = at[(after[at] >= np.repeat(right.astype(np.int32), sizes)) & at_inside]
        left, right = np.sort(leads[first]), np.sort(leads[last]) + 1
        new = ~short[left]
        short[left] = True
        left, right = left[new], right[new]
    return short


def repeated_starts(strings: list[np.ndarray], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """For each string, which of its starts of a ``length`` occur twice, weights counted.

    A string of weight w stands for w places with the same bytes.
    """
    lengths = np.array([len(s) for s in strings], np.int64)
    k = len(strings)
    if not k:
        return []
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    symbols = np.concatenate([np.append(s.astype(np.int64) + k, i) for i, s in enumerate(strings)])
    order = suffixes(symbols, int(lengths.max()) + 1)
    short = long_prefix_runs(symbols, order, k, length)
    owner = np.repeat(np.arange(k), lengths + 1)
    full = np.arange(len(symbols)) <= (ends - 1 - length)[owner]
    heads = np.flatnonzero(short)
    sums = np.add.reduceat(np.where(full, np.asarray(weights)[owner], 0)[order], heads)
    repeated = np.zeros(len(symbols), bool)
    repeated[order] = np.repeat(sums, np.diff(np.append(heads, len(symbols)))) >= 2
    repeated &= full
    return [repeated[a : a + max(0, n - length + 1)] for a, n in zip(starts, lengths, strict=True)]
