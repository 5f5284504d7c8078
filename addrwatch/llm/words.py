"""Words of whole texts as numpy arrays, found byte by byte in UTF-8.

A word is a longest run of ASCII letters, digits and characters beyond ASCII; A-Z count as
a-z. Every byte of a character beyond ASCII is 0x80 or more, so bytes can be judged alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from addrwatch.llm import tables

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IS_WORD = np.zeros(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    IS_WORD[ord(_first) : ord(_last) + 1] = True
IS_WORD[0x80:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)[LOWER]


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = int(_BASE)) -> np.ndarray:
    """base to the power 0, 1, ..., modulo two to the power 64; kept for the next call, up to a bound."""
    n = max(n, 1)
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), np.uint64(base))
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if len(known) <= 1 << 23:
            _POWERS[base] = known
    return known[:n]


def inverse_powers(n: int) -> np.ndarray:
    """The inverses of ``powers``."""
    return powers(n, pow(int(_BASE), -1, 1 << 64))


@dataclass
class Words:
    """Words of a run of texts: byte ranges in ``data``, 64-bit hashes, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text(self, word: int, n: int = 1) -> bytes:
        """n words in lower case, joined by blanks."""
        return b" ".join(
            LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes() for i in range(word, word + n))


def read(texts: pa.Array) -> Words:
    data, offsets = tables.raw(texts)
    inside = IS_WORD[data]
    place = np.flatnonzero(inside)
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    begins = np.flatnonzero(inside & ~before)
    if not len(begins):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    at = np.searchsorted(place, begins)
    lengths = np.diff(np.append(at, len(place)))
    within = np.arange(len(place)) - np.repeat(at, lengths)
    hashes = np.add.reduceat(_BYTE[data[place]] * powers(int(lengths.max()))[within], at)
    first = np.searchsorted(begins, offsets)
    return Words(data, begins, begins + lengths, mix(hashes + lengths.astype(np.uint64)), first)
