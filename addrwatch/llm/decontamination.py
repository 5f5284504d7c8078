"""Benchmark passages in documents, found by Wu and Manber's multi-pattern search over words.

Symbols are 64-bit hashes of words, patterns the windows of consecutive benchmark words. A
table tells for each block of two words how far the search may jump; where it may not, the
block's bucket holds the windows that end so, and their text is compared with the document's.
Windows of one length are searched together. The search runs along many stretches of the
documents side by side, a numpy step for all of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from addrwatch.llm import tables, words

WINDOW = 13
#: Benchmark text that is searched in one pass over the documents; more of it makes more passes.
PASS_BYTES = 32 << 20
#: End positions that one search goes along.
STRETCH = 512

RESULTS = ("n_words", "n_hit", "item_ids", "contaminated")


class Windows:
    """All windows of some benchmark items, ready for the search."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        found: dict[bytes, tuple[np.ndarray, set[str]]] = {}
        for item, text in items:
            own = words.read(pa.array([text or ""]))
            n = len(own.hashes)
            size = min(n, window)
            for i in range(n - size + 1 if n else 0):
                found.setdefault(own.text(i, size), (own.hashes[i : i + size], set()))[1].add(item)
        by_size = defaultdict(list)
        for text, (hashes, names) in found.items():
            by_size[len(hashes)].append((text, hashes, sorted(names)))
        self.groups = [_Group(size, group) for size, group in sorted(by_size.items())]


class _Group:
    """Windows of one number of words."""

    def __init__(self, size: int, patterns: list[tuple[bytes, np.ndarray, list[str]]]):
        self.size, self.block = size, min(2, size)
        self.bits = min(24, max(16, int(np.ceil(np.log2(8 * size * len(patterns) + 1)))))
        hashes = np.array([p[1] for p in patterns], np.uint64).reshape(len(patterns), size)
        self.shift = np.full(1 << self.bits, size - self.block + 1, np.int64)
        for end in range(self.block, size + 1):
            np.minimum.at(self.shift, self._slot(hashes[:, end - self.block : end]), size - end)
        self.bucket: dict[tuple[int, int], list[tuple[bytes, list[str]]]] = defaultdict(list)
        last, head = self._slot(hashes[:, -self.block :]), self._slot(hashes[:, : self.block])
        for a, b, (text, _, names) in zip(last.tolist(), head.tolist(), patterns, strict=True):
            self.bucket[a, b].append((text, names))
        self.pairs = np.unique(last << self.bits | head)

    def _slot(self, block: np.ndarray) -> np.ndarray:
        mixed = block[:, 0] if self.block == 1 else block[:, 0] * np.uint64(31) + block[:, 1]
        return (words.mix(mixed) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _slot_at(self, hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._slot(hashes[ends[:, None] + np.arange(1 - self.block, 1)])

    def search(self, text: words.Words) -> Iterator[tuple[int, list[str]]]:
        """First word and items of each window that occurs."""
        counts = np.diff(text.first)
        docs = np.flatnonzero(counts >= self.size)
        lanes = -(-(counts[docs] - self.size + 1) // STRETCH)
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(text.first[docs] + self.size - 1, lanes) + nth * STRETCH
        stop = np.minimum(at + STRETCH, np.repeat(text.first[docs + 1], lanes))
        while len(at):
            jump = self.shift[self._slot_at(text.hashes, at)]
            yield from self._confirmed(text, at[jump == 0])
            at = at + np.maximum(jump, 1)
            left = at < stop
            at, stop = at[left], stop[left]

    def _confirmed(self, text: words.Words, ends: np.ndarray) -> Iterator[tuple[int, list[str]]]:
        if not len(ends):
            return
        last, head = self._slot_at(text.hashes, ends), self._slot_at(text.hashes, ends - self.size + self.block)
        pair = last << self.bits | head
        near = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        for i in np.flatnonzero(self.pairs[near] == pair).tolist():
            first = int(ends[i]) - self.size + 1
            own = text.text(first, self.size)
            for pattern, names in self.bucket[int(last[i]), int(head[i])]:
                if pattern == own:
                    yield first, names


def _marks(text: words.Words, windows: Windows) -> tuple[list[set[str]], np.ndarray]:
    """Items of each document, and whether each word is inside an occurrence."""
    n = len(text.first) - 1
    items: list[set[str]] = [set() for _ in range(n)]
    edges = np.zeros(len(text.hashes) + 1, np.int64)
    for group in windows.groups:
        for first, names in group.search(text):
            items[int(np.searchsorted(text.first, first, side="right")) - 1].update(names)
            edges[first] += 1
            edges[first + group.size] -= 1
    return items, np.cumsum(edges)[:-1] > 0


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Every document with ``n_words``, ``n_hit``, ``item_ids`` (sorted strings) and ``contaminated``.

    A window is ``window`` consecutive words of an item, or a shorter item whole; an item
    without words has none. Words inside any occurrence are hit; a document is contaminated
    when at least one word of ``one_in``, and at least one, is. Null texts have no words.
    Repeated rows are judged one by one; an item that occurs twice in the benchmark counts
    once. Input columns named like a result are replaced, all others kept.

    The benchmark is read to the driver part by part: its size is summed first, and beyond
    ``pass_bytes`` it is cut by a hash of the item and searched in as many passes.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    items = items.where("item IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-total // pass_bytes))
    plain = docs.select(*tables.without(docs, *RESULTS, "_marked"))
    names = [*plain.columns, "n_words", "n_hit", "item_ids", "_marked"]
    text_at = plain.columns.index(text_col)
    marked = plain.withColumns({
        "n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"),
        "item_ids": F.array().cast("array<string>"), "_marked": F.lit(None).cast("binary")})
    schema = marked.schema
    for part in range(passes):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == part)
        windows = docs.sparkSession.sparkContext.broadcast(Windows([tuple(r) for r in own.collect()], window))

        def searched(batches: Iterator[pa.RecordBatch], windows=windows) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for cut in tables.slices(batch, text_col):
                    text = words.read(cut.column(text_at))
                    found, hit = _marks(text, windows.value)
                    for i, (old, before) in enumerate(zip(cut.column(len(names) - 1).to_pylist(),
                                                          cut.column(len(names) - 2).to_pylist(), strict=True)):
                        if old:  # what earlier passes found
                            hit[text.first[i] : text.first[i + 1]] |= np.frombuffer(old, bool)
                            found[i].update(before)
                    total = np.concatenate(([0], np.cumsum(hit)))[text.first]
                    kept = [hit[a:b].tobytes() if names_ else None
                            for a, b, names_ in zip(text.first, text.first[1:], found, strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [*cut.columns[:-4], pa.array(np.diff(text.first)), pa.array(np.diff(total)),
                         pa.array(list(map(sorted, found)), pa.list_(pa.string())), pa.array(kept, pa.binary())], names)

        marked = tables.mapped(marked, searched, schema)
        if part + 1 < passes:
            marked = tables.stored(marked, "benchmark-pass")
    return marked.drop("_marked").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))
