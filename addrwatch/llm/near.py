"""Near-duplicate documents: consistent weighted samples over TF-IDF shingles, banded and verified.

A shingle is five words in a row (a shorter text is one shingle). Its weight is how often it is
in the text, times the mean inverse document frequency of its words; those are counted over
all documents, in a table of fixed size by a hash of the word. Improved consistent weighted
sampling draws a (shingle, level) per sample, equal for two texts with the probability of their
weighted Jaccard similarity. Texts that agree in all samples of a band meet, and those with a
similarity of at least THRESHOLD are linked; classes are the connected components.

Texts with the same words are one node from the start. Within a band's bucket every node is
verified against the least one. A bucket that holds one class then needs no more. The nodes of
the others, such as those that a common passage brings together, are told apart by an exact
prefix rule: two texts at the threshold must share a shingle among the rarest of each, those
left when the commonest ones with less than the threshold's share of a text's weight are taken away.
Frequencies are counted over those nodes. In each bucket of such a shingle the nodes outside its largest
class are verified against all nodes of other classes: pair by pair in small buckets; in larger ones
both sides are dealt to blocks, and each pair of blocks is compared in one task, so that a text is
read once per block of partners and no row is made for a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from addrwatch.llm import components, tables, words

SHINGLE = 5
THRESHOLD = 0.8
#: Bands and samples in each: two texts at the threshold meet with a probability of 0.9997.
BANDS, SAMPLES = 8, 2
#: Nodes of a bucket that are verified pair by pair; larger ones are compared in blocks.
PAIRED = 32
#: Nodes and bytes of text in a block, about, and shingles that two blocks are compared by at a time.
BLOCK, BLOCK_BYTES, COLUMNS = 1024, 4 << 20, 2048
#: Around the threshold the similarity from sums in single precision is computed anew.
CLOSE = 1e-3
#: What rounding may add to or take from a share of a text's weight.
ROUNDING = 1e-4
#: Texts that are verified against one text in a task.
GROUP = 64
#: Entries of the table of document frequencies, as a power of two.
TABLE_BITS = 18

SIGNED = "row long, doc_id long, text_key long, text_bytes int, fp1 long, fp2 long, bands array<long>"

_RANDOM = np.random.default_rng(20_251)
_R = _RANDOM.gamma(2.0, 1.0, 1 << 16)
_LOG_C = np.log(_RANDOM.gamma(2.0, 1.0, 1 << 16))
_BETA = _RANDOM.random(1 << 16)


class Weights:
    """Weighted shingles of a run of texts, those of a text together and in a fixed order."""

    def __init__(self, texts: pa.Array, idf: np.ndarray, size: int = SHINGLE):
        text = words.read(texts)
        counts = np.diff(text.first)
        n_docs = len(counts)
        rarity = idf[(text.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
        total = np.concatenate(([0], np.cumsum(rarity)))
        n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
        doc = np.repeat(np.arange(n_docs), n)
        start = np.repeat(text.first[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        span = np.minimum(size, counts)[doc]
        hashes = np.zeros(len(doc), np.uint64)
        for k in range(size):
            own = span > k
            at = start[own] + k
            hashes[own] = words.mix(hashes[own] * np.uint64(0x9FB21C651E98DF25) + text.hashes[at] + np.uint64(k))
        weight = (total[start + span] - total[start]) / np.maximum(span, 1)
        order = np.argsort(doc.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24), kind="stable")
        doc, hashes, weight = doc[order], hashes[order], weight[order]
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        times = np.diff(np.append(heads, len(doc)))
        self.doc, self.hashes, self.weights, self.times = doc[heads], hashes[heads], weight[heads] * times, times
        self.first = np.searchsorted(self.doc, np.arange(n_docs + 1))
        # Two hashes of the words in their order.
        power = words.powers(int(counts.max()) if n_docs else 1)
        place = np.arange(len(text.hashes)) - np.repeat(text.first[:-1], counts)
        self.prints = [_sums(words.mix(text.hashes + np.uint64(k)) * power[place], text.first) + counts.astype(np.uint64) for k in (1, 2)]

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.first[i], self.first[i + 1])
        return self.hashes[own], self.weights[own]

    def samples(self, count: int, seed: int = 0) -> np.ndarray:
        """One row of sample hashes per text that has words (``present``)."""
        starts = self.first[:-1][self.present]
        sizes = np.diff(self.first)[self.present]
        out = np.zeros((len(starts), count), np.uint64)
        log_w = np.log(self.weights)
        for k in range(count if len(starts) else 0):
            z = words.mix(self.hashes + np.uint64((seed + k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            r, c, beta = _R[z >> np.uint64(48)], _LOG_C[z >> np.uint64(32) & np.uint64(0xFFFF)], _BETA[z >> np.uint64(16) & np.uint64(0xFFFF)]
            level = np.floor(log_w / r + beta)
            log_a = c - r * (level - beta + 1)
            least = np.minimum.reduceat(log_a, starts)
            hit = np.flatnonzero(log_a == np.repeat(least, sizes))
            at = hit[np.searchsorted(hit, starts)]
            out[:, k] = words.mix(self.hashes[at] ^ level[at].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return out

    @property
    def present(self) -> np.ndarray:
        return np.diff(self.first) > 0


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return words.mix(total[first[1:]] - total[first[:-1]])


def _bands(samples: np.ndarray, size: int) -> np.ndarray:
    """One number per band of so many samples."""
    out = np.zeros((len(samples), samples.shape[1] // size), np.uint64)
    for k in range(size):
        out = words.mix(out * np.uint64(31) + samples[:, k::size])
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' (hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(1e-300, float(a[1].sum() + b[1].sum()) - both)


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """1 + ln((1 + documents) / (1 + documents with a word of the entry)), for the whole table."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(1 << TABLE_BITS, np.int64), 0
        for batch in batches:
            for part in tables.slices(batch, "text"):
                text = words.read(part.column(0))
                doc = np.repeat(np.arange(part.num_rows), np.diff(text.first))
                entry = (text.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
                seen += np.bincount(np.unique(doc << TABLE_BITS | entry) & (1 << TABLE_BITS) - 1, minlength=1 << TABLE_BITS)
                n += part.num_rows
        entries = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(entries, -1)), pa.array(np.append(seen[entries], n))], ["entry", "n"])

    own = tables.mapped(docs.select(F.col(text_col).cast("string").alias("text")), counted, "entry long, n long")
    rows = own.groupBy("entry").agg(F.sum("n").alias("n")).toPandas()  # at most the table's size
    seen = np.zeros(1 << TABLE_BITS)
    known = rows["entry"] >= 0
    seen[rows["entry"][known].to_numpy(np.int64)] = rows["n"][known]
    total = float(rows["n"][~known].sum())
    return 1 + np.log((1 + total) / (1 + seen))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with ``class_id`` and ``n_links``, and what identifies its row: doc_id, text_key, text_bytes.

    ``class_id`` is the least row number (any number) of a class; ``n_links`` counts the verified links
    of its words to other words. Texts with the same words in the same order are in one class. Texts
    without words, null and empty ones, are classes of their own, row by row. Repeated
    rows are copies. Other columns are left out.
    """
    docs = tables.ids_of(docs, id_col, text_col)
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs))
    keyed = docs.withColumns({"text_key": F.xxhash64("text"), "text_bytes": F.coalesce(F.octet_length("text"), F.lit(0))})

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in tables.slices(batch, "text"):
                own = Weights(tables.column(part, "text"), idf.value)
                bands = np.zeros((part.num_rows, BANDS), np.uint64)
                bands[own.present] = _bands(own.samples(BANDS * SAMPLES), SAMPLES)
                lists = [b if p else [] for b, p in zip(bands.view(np.int64).tolist(), own.present, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + part.num_rows)), *(tables.column(part, c) for c in ("doc_id", "text_key", "text_bytes")),
                     *(pa.array(p.view(np.int64)) for p in own.prints), pa.array(lists, pa.list_(pa.int64()))],
                    ["row", "doc_id", "text_key", "text_bytes", "fp1", "fp2", "bands"])
                row += part.num_rows

    signs = tables.stored(tables.mapped(keyed, signed, SIGNED), "signatures")
    worded = signs.where("size(bands) > 0")
    nodes = tables.stored(
        worded.groupBy("fp1", "fp2").agg(F.min(F.struct("row", "text_key", "text_bytes", "bands")).alias("s")).select(
            "fp1", "fp2", F.col("s.row").alias("node"), "s.text_key", "s.text_bytes", "s.bands"), "nodes")
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    held = buckets.groupBy("band", "key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    met = tables.stored(buckets.join(held, ["band", "key"]), "buckets")
    texts = _texts(keyed, nodes, met)
    pairs = met.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = [tables.stored(_verified(pairs, texts, idf, threshold), "near-links")]
    classes = components.connected(links[0])
    open_ = _mixed(_by_prefix(_mixed(met.select("band", "key", "node"), classes), texts, idf, threshold), classes)
    more = tables.stored(_across(open_.join(nodes.select("node", "text_bytes"), "node"), texts, idf, threshold), "near-links")
    if not more.isEmpty():
        links.append(more)
        classes = components.extended(classes, more)
    every = reduce(DataFrame.unionByName, (x.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for x in links)).distinct()
    degree = every.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    known = nodes.select("fp1", "fp2", "node").join(classes, "node", "left").join(degree, "node", "left")
    found = known.select("fp1", "fp2", F.coalesce("component", "node").alias("_class"), F.col("n_links").alias("_links"))
    return (worded.join(found, ["fp1", "fp2"]).select("row", "doc_id", "text_key", "text_bytes", "_class", "_links")
            .unionByName(signs.where("size(bands) = 0").select("row", "doc_id", "text_key", "text_bytes"), allowMissingColumns=True)
            .select("doc_id", "text_key", "text_bytes", F.coalesce("_class", "row").alias("class_id"), F.coalesce("_links", F.lit(0)).alias("n_links")))


def _texts(keyed: DataFrame, nodes: DataFrame, met: DataFrame) -> DataFrame:
    """(node, text) of the nodes that meet another one, stored in buckets by node: no round shuffles all of them again."""
    wanted = met.select("node").distinct().join(nodes.select("node", "text_key", "text_bytes"), "node")
    texts = keyed.select("text_key", "text_bytes", "text").dropDuplicates(["text_key", "text_bytes"])
    return tables.bucketed(texts.join(wanted, ["text_key", "text_bytes"]).select("node", "text"), "node", "near_texts")


def _verified(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) that are similar enough; a text with many partners is dealt to many tasks."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("_groups"))
    dealt = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("_groups")).alias("deal"), F.col("b").alias("node"))
    sides = dealt.unionByName(dealt.select("a", "deal", F.col("a").alias("node")).distinct()).join(texts, "node")

    def compared(group: pa.Table) -> pa.Table:
        a, node = (np.asarray(tables.column_of(group, c)) for c in ("a", "node"))
        text = tables.column_of(group, "text")
        head = int(np.flatnonzero(node == a)[0])
        one = Weights(text.slice(head, 1), idf.value).of(0)
        found = []
        for batch in pa.table({"node": pa.array(node), "text": text}).combine_chunks().to_batches():
            for part in tables.slices(batch, "text"):
                own = Weights(tables.column(part, "text"), idf.value)
                for i, other in enumerate(tables.column(part, "node").to_pylist()):
                    if other != a[head] and similarity(one, own.of(i)) >= threshold:
                        found.append(other)
        return pa.table({"a": pa.array([a[head]] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return sides.groupBy("a", "deal").applyInArrow(compared, "a long, b long")


def _mixed(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """(band, key, node, component) of the buckets with more than one class, stored."""
    known = buckets.join(classes, "node", "left").select("band", "key", "node", F.coalesce("component", "node").alias("component"))
    mixed = known.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return tables.stored(known.join(mixed.select("band", "key"), ["band", "key"]), "mixed-buckets")


def _by_prefix(open_: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """(band, key, node): new buckets for all nodes of the open ones, one per shingle that is among the rarest of two nodes.

    Shingles are ordered by the number of nodes that have them. Two texts at the threshold share at least
    its part of either's weight, so more than what lies behind the prefix: no link is lost here. A shingle
    of one node only is in no bucket, but counts in its text's weight.
    """
    own = tables.stored(open_.select("node").distinct().join(texts, "node"), "open-texts")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tables.slices(batch, "text"):
                found = Weights(tables.column(part, "text"), idf.value)
                whole = np.bincount(found.doc, found.weights, part.num_rows)
                node = np.asarray(tables.column(part, "node"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.hashes.view(np.int64)), pa.array(node[found.doc]),
                     pa.array((found.weights / whole[found.doc]).astype(np.float32))], ["key", "node", "share"])

    shingles = tables.mapped(own, shingled, "key long, node long, share float")
    common = shingles.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    commonest = Window.partitionBy("node").orderBy(F.desc("n"), F.desc("key")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = shingles.join(common, "key").withColumn("behind", F.sum("share").over(commonest))
    rare = placed.where(F.col("behind") >= threshold - ROUNDING).select(F.lit(BANDS).alias("band"), "key", "node")
    return tables.stored(rare, "prefix-buckets")


def _across(open_: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Links (a, b) between nodes of different classes in each bucket (band, key, node, component, text_bytes)."""
    counts = open_.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("text_bytes").alias("bytes"))
    top = F.max(F.struct("n", "component", "bytes"))
    sizes = counts.groupBy("band", "key").agg(
        top["component"].alias("top"), F.sum("n").alias("all"), (F.sum("n") - top["n"]).alias("out"),
        F.sum("bytes").alias("all_bytes"), (F.sum("bytes") - top["bytes"]).alias("out_bytes"))
    sized = tables.stored(open_.join(sizes, ["band", "key"]), "sized-buckets")
    small = sized.where(F.col("all") <= PAIRED)
    outer = small.where("component <> top").select("band", "key", F.col("node").alias("a"), F.col("component").alias("one"))
    pairs = outer.join(small, ["band", "key"]).where("one <> component").select("a", F.col("node").alias("b")).distinct()
    blocks = _blocks(sized.where(F.col("all") > PAIRED)).join(texts, "node")

    def compared(group: pa.Table) -> pa.Table:
        left, node, component = (np.asarray(tables.column_of(group, c).to_pylist()) for c in ("left", "node", "component"))
        text = tables.column_of(group, "text")
        one, two = np.flatnonzero(left), np.flatnonzero(~left)
        a, b = _similar(_shingles(text.take(pa.array(one)), idf.value), _shingles(text.take(pa.array(two)), idf.value),
                        component[one][:, None] != component[two], threshold)
        return pa.table({"a": pa.array(node[one][a], pa.int64()), "b": pa.array(node[two][b], pa.int64())})

    return _verified(pairs, texts, idf, threshold).unionByName(blocks.groupBy("task").applyInArrow(compared, "a long, b long"))


def _blocks(sized: DataFrame) -> DataFrame:
    """(task, left, node, component): nodes outside a bucket's largest class on the left, all of the bucket's on the right.

    Both are dealt to blocks; a task has one block of each, and a node has a row per block of the other side.
    """
    lefts, rights = (F.ceil(F.greatest(F.col(c) / BLOCK, F.col(f"{c}_bytes") / BLOCK_BYTES)) for c in ("out", "all"))
    own = sized.withColumns({"i": F.pmod(F.xxhash64("node"), lefts), "j": F.pmod(F.xxhash64("node"), rights)})
    left = own.where("component <> top").withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), rights - 1))).withColumn("left", F.lit(True))
    right = own.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), lefts - 1))).withColumn("left", F.lit(False))
    return left.unionByName(right).select(F.xxhash64("band", "key", "i", "j").alias("task"), "left", "node", "component")


def _shingles(texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, hash, weight and number of every shingle of the texts."""
    found, first = [], 0
    for part in tables.slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
        own = Weights(tables.column(part, "text"), idf)
        found.append((own.doc + first, own.hashes, own.weights, own.times))
        first += part.num_rows
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _similar(one: tuple, two: tuple, wanted: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted pairs (a row per text of one side, a column per text of the other) are similar enough.

    What two texts share adds up column by column, a column being a shingle of both sides. Where one
    side has it once per text, the sum is a product of matrices.
    """
    totals = [np.bincount(x[0], x[2], n) for x, n in zip((one, two), wanted.shape, strict=True)]
    columns = np.intersect1d(one[1], two[1])
    both = np.zeros(wanted.shape, np.float32)
    sides = []
    for doc, hashes, weights, times in (one, two):
        at = np.searchsorted(columns, hashes)
        held = np.flatnonzero(columns[np.minimum(at, len(columns) - 1)] == hashes) if len(columns) else np.zeros(0, np.int64)
        held = held[np.argsort(at[held], kind="stable")]
        most = np.zeros(len(columns), np.int64)
        np.maximum.at(most, at[held], times[held])
        sides.append((doc[held], at[held], weights[held], times[held], most))
    often = np.minimum(sides[0][4], sides[1][4]) > 1
    for low in range(0, len(columns), COLUMNS):
        dense = []
        for (doc, at, weights, times, _), n, weighted in zip(sides, wanted.shape, (True, False), strict=True):
            own = slice(*np.searchsorted(at, (low, low + COLUMNS)))
            filled = np.zeros((n, min(COLUMNS, len(columns) - low)), np.float32)
            filled[doc[own], at[own] - low] = np.where(often[at[own]], 0, weights[own] / times[own] if weighted else 1)
            dense.append(filled)
        both += dense[0] @ dense[1].T
    for column in np.flatnonzero(often):
        own = [slice(*np.searchsorted(at, (column, column + 1))) for _, at, *_ in sides]
        (a, _, x, *_), (b, _, y, *_) = ([c[cut] for c in side[:4]] for side, cut in zip(sides, own, strict=True))
        both[np.ix_(a, b)] += np.minimum.outer(x, y)
    share = both / np.maximum(1e-30, totals[0][:, None] + totals[1] - both)
    a, b = np.nonzero(wanted & (share >= threshold - CLOSE))
    sure = share[a, b] >= threshold + CLOSE
    for k in np.flatnonzero(~sure):
        (x, y) = ((side[1][own], side[2][own]) for side, own in (
            (side, slice(*np.searchsorted(side[0], (at, at + 1)))) for side, at in ((one, a[k]), (two, b[k]))))
        sure[k] = similarity(x, y) >= threshold
    return a[sure], b[sure]
