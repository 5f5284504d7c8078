"""Ranked lexical search by a K2-treap over the grid of terms and documents.

The grid has a row per term and a column per document; its entries are impacts. A K2-treap is a
quadtree over the grid: one bit for each quadrant that holds an entry, level after level in a single
bitmap with rank counts, and the largest impact of each such cell. An item's terms are rows. Starting at
the root, the search keeps document ranges, each with the cell of every row of the item, ordered by the sum of weight times
the cells' maxima: a bound that no document of the range exceeds. The best ranges are halved, all rows descending
together, until they are single documents; ranges that can't reach the k-th score any more are dropped.

Documents are read once: their counts of the items' terms are stored, narrow. Each task builds treaps over the
documents it reads, without a shuffle, and returns the k best of each; a window merges those per item. Items come in
blocks of bounded size. A word is what ``words`` says.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from addrwatch.llm import tables, words

#: Text of the items of a block, whose vocabulary goes to every task.
BLOCK_BYTES = 2 << 20
#: A treap ends at so many documents or entries, whichever comes first.
PART_DOCUMENTS, PART_ENTRIES = 16_384, 2_000_000
#: Ranges halved together; the best ones first.
TOGETHER = 128


class Vocabulary:
    """Distinct terms, found in texts by hash and then byte by byte."""

    def __init__(self, terms: list[bytes]):
        self.terms = sorted(terms)
        read = words.read(pa.array(self.terms, pa.binary()))
        self.data, self.starts, self.lengths = read.data, read.starts, read.ends - read.starts
        self.order = np.argsort(read.hashes, kind="stable")
        self.hashes = read.hashes[self.order]

    def __len__(self) -> int:
        return len(self.terms)

    def numbers(self, found: words.Words) -> np.ndarray:
        """The number of every word's term, -1 for other words."""
        at = np.full(len(found.hashes), -1, np.int64)
        if not len(self) or not len(at):
            return at
        # Terms with equal hashes stand side by side; each round tries the next of them.
        place, open_words = np.searchsorted(self.hashes, found.hashes), np.arange(len(at))
        while len(open_words):
            inside = place < len(self)
            open_words, place = open_words[inside], place[inside]
            same = self.hashes[place] == found.hashes[open_words]
            open_words, place = open_words[same], place[same]
            equal = self._equal(found, open_words, self.order[place])
            at[open_words[equal]] = self.order[place[equal]]
            open_words, place = open_words[~equal], place[~equal] + 1
        return at

    def _equal(self, found: words.Words, at: np.ndarray, term: np.ndarray) -> np.ndarray:
        n = found.ends[at] - found.starts[at]
        equal = n == self.lengths[term]
        n = np.where(equal, n, 0)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        differs = words.LOWER[found.data[np.repeat(found.starts[at], n) + within]] != self.data[np.repeat(self.starts[term], n) + within]
        equal[np.repeat(np.arange(len(at)), n)[differs]] = False
        return equal


class Treap:
    """A K2-treap over (row, column, impact), each place at most once."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, side: int):
        self.height = max(1, int(side - 1).bit_length())
        code = np.zeros(len(rows), np.int64)
        for bit in range(self.height):
            code |= ((rows >> bit & 1) << (2 * bit + 1)) | ((columns >> bit & 1) << (2 * bit))
        order = np.argsort(code, kind="stable")
        code, best = code[order], impacts[order]
        maxima, bitmap = [best], []
        for _ in range(self.height):
            parent = code >> 2
            first = np.flatnonzero(np.diff(parent, prepend=-1))
            bits = np.zeros(4 * len(first), bool)
            bits[4 * (np.searchsorted(first, np.arange(len(code)), side="right") - 1) + (code & 3)] = True
            bitmap.append(bits)
            code = parent[first]
            best = np.maximum.reduceat(best, first) if len(first) else best
            maxima.append(best)
        self.maxima = np.concatenate(maxima[::-1])
        packed = np.packbits(np.concatenate(bitmap[::-1]), bitorder="little")
        self.bits = np.frombuffer(packed.tobytes() + bytes(8 + -len(packed) % 8), "<u8")
        self.ranks = np.cumsum(np.bitwise_count(self.bits), dtype=np.int64) - np.bitwise_count(self.bits)

    def children(self, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The cells' children in the quadrants, -1 where there is none; -1 stays -1."""
        at = np.where(cells < 0, 0, 4 * cells + quadrant)
        word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
        there = (word >> bit & np.uint64(1)).astype(bool) & (cells >= 0)
        before = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        return np.where(there, self.ranks[at >> 6] + before + 1, -1)

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of the k columns with the highest positive sum of weight times impact, least columns first."""
        columns, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(rows) or not len(self.maxima):
            return columns, scores
        bound = np.array([int(weights.sum()) * int(self.maxima[0])])
        level, prefix, cells = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int64)
        while len(bound):
            first = prefix << (self.height - level)
            order = np.lexsort((first, -bound))
            now, later = order[:TOGETHER], order[TOGETHER:]
            depth = level[now]
            row_bits = rows[None, :] >> (self.height - 1 - depth)[:, None] & 1
            below = np.concatenate([self.children(cells[now], 2 * row_bits + side) for side in (0, 1)])
            sums = np.where(below >= 0, self.maxima[below], 0) @ weights
            to = np.concatenate((2 * prefix[now], 2 * prefix[now] + 1))
            depth = np.concatenate((depth, depth)) + 1
            done = (depth == self.height) & (sums > 0)
            if done.any():
                columns, scores = np.concatenate((columns, to[done])), np.concatenate((scores, sums[done]))
                kept = np.lexsort((columns, -scores))[:k]
                columns, scores = columns[kept], scores[kept]
            open_ranges = (depth < self.height) & (sums > 0)
            bound = np.concatenate((bound[later], sums[open_ranges]))
            level = np.concatenate((level[later], depth[open_ranges]))
            prefix = np.concatenate((prefix[later], to[open_ranges]))
            cells = np.concatenate((cells[later], below[open_ranges]))
            if len(scores) == k:
                may = (bound > scores[-1]) | (bound == scores[-1]) & (prefix << (self.height - level) < columns[-1])
                bound, level, prefix, cells = bound[may], level[may], prefix[may], cells[may]
        return columns, scores


def impact(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term's occurrences count for in a document of so many terms, by integers."""
    norm = 100 - 50 + 50 * length * n_docs // max(n_terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 20 * norm)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of each item with the highest score above 0.

    Equal scores go by ascending identifier, a null identifier last. Null and empty texts have no terms: such
    documents count in no statistic and such items have no rows. Repeated document rows are documents of their own;
    equal rows of the items are one item. Other columns are not read.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).distinct()
    asked = tables.stored(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "text").toArrow()
        part = _searched(spark, plain, own, k)
        found = part if found is None else found.unionByName(part)
    found = tables.stored(found, "found") if blocks > 1 else found
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _searched(spark, docs: DataFrame, items: pa.Table, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of every item in every treap."""
    read = words.read(tables.column_of(items, "text"))
    texts = np.array([read.text(i) for i in range(len(read.hashes))], object)
    vocabulary = Vocabulary(list(set(texts.tolist())))
    number = {t: i for i, t in enumerate(vocabulary.terms)}
    rows = [np.unique([number[t] for t in texts[a:b]]).astype(np.int64) for a, b in zip(read.first[:-1], read.first[1:], strict=True)]
    item_ids = tables.column_of(items, "item").to_numpy()

    counts = _counts(spark, docs, vocabulary)
    n_docs, n_terms = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # of the block's vocabulary
        df[term] = n
    weights = np.array([weight(int(x), n_docs) for x in df], np.int64)
    shared = spark.sparkContext.broadcast((rows, weights, item_ids))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, weights, item_ids = shared.value
        for part in _parts(batches):
            part = part.take(pc.sort_indices(part.column("doc_id")))  # a null identifier comes last
            terms, tf = (tables.column_of(part, c) for c in ("terms", "tfs"))
            lengths = np.asarray(tables.column_of(part, "n"))
            entries = np.diff(np.asarray(terms.offsets))
            column = np.repeat(np.arange(part.num_rows), entries)
            row = np.asarray(terms.flatten()).astype(np.int64)
            impacts = impact(np.asarray(tf.flatten()).astype(np.int64), lengths[column], n_docs, n_terms)
            treap = Treap(row, column, impacts, max(part.num_rows, len(weights)))
            ids = tables.column_of(part, "doc_id")
            for item, own in zip(item_ids, rows, strict=True):
                own = own[weights[own] > 0]
                columns, scores = treap.best(own, weights[own], k)
                if len(columns):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(columns), item)), ids.take(pa.array(columns)), pa.array(scores)],
                        ["item", "doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    parts = max(1, -(-counts.count() // PART_DOCUMENTS))
    few = counts.where("size(terms) > 0").coalesce(max(parts, min(counts.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)))
    return tables.mapped(few, searched, f"item long, doc_id {id_type}, score long")


def _counts(spark, docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's number of words and how often it has the terms of the vocabulary."""
    shared = spark.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for cut in tables.slices(batch, "text"):
                found = words.read(tables.column(cut, "text"))
                number = vocabulary.numbers(found)
                doc = np.repeat(np.arange(cut.num_rows), np.diff(found.first))
                known = number >= 0
                pairs, tf = np.unique(doc[known] * max(len(vocabulary), 1) + number[known], return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(cut.num_rows + 1) * max(len(vocabulary), 1))
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32()))
                         for x in (pairs % max(len(vocabulary), 1), tf)]
                yield pa.RecordBatch.from_arrays(
                    [tables.column(cut, "doc_id"), pa.array(np.diff(found.first).astype(np.int64)), *lists],
                    ["doc_id", "n", "terms", "tfs"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return tables.stored(tables.mapped(docs, counted, f"doc_id {id_type}, n long, terms array<int>, tfs array<int>"), "counts")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined up to the bounds of a treap."""
    held, rows, entries = [], 0, 0
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.list_value_length(tables.column(batch, "terms"))).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            done = int(ends[first - 1]) if first else 0
            last = min(first + PART_DOCUMENTS - rows, int(np.searchsorted(ends, done + PART_ENTRIES - entries, side="right")), batch.num_rows)
            last = max(last, first + 1) if not rows else max(last, first)
            held.append(batch.slice(first, last - first))
            rows, entries = rows + last - first, entries + (int(ends[last - 1]) - done if last > first else 0)
            if last < batch.num_rows or rows >= PART_DOCUMENTS:
                yield pa.Table.from_batches(held)
                held, rows, entries = [], 0, 0
            first = last
    if rows:
        yield pa.Table.from_batches(held)
