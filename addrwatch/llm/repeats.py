"""Removal of bytes covered by long strings that occur more than once in a corpus.

A string of LENGTH bytes is found twice only if both places pick the same anchor: the k-gram with
the least hash among those inside the string, the rightmost of equals. So each run of starts
with one anchor becomes a context, the bytes of all its strings, and contexts with equal
anchors are brought together; an anchor that occurs once needs no more work. Equal contexts are
counted, not repeated. The different ones are put into groups by anchor, and
in each group interval expansion on a Burrows-Wheeler transform (``bwt``) tells which starts
have a common prefix of LENGTH with another one.

An anchor with more than HOT_CONTEXTS different contexts would make a group too large for a
task; its strings are then told apart one by one, by hashes counted over all of Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from addrwatch.llm import bwt, tables, words
from addrwatch.session import ship_package

LENGTH = 200
GRAM = 32
#: Different contexts of an anchor that go into one group.
HOT_CONTEXTS = 2000
#: Bytes of the contexts of a group, about.
GROUP_BYTES = 1 << 20
#: Starts that are hashed in one go.
RUN = 1 << 22

ANCHORS = "part long, row long, first int, n int, anchor long, context long"
_BYTES = words.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))


class _Rolling:
    """Hashes of any ranges of some bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.back = (np.full(n + 1, x) for x in (_STEP, _BACK))
        power[0] = self.back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(self.back, out=self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * power[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        return words.mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, first start, number of starts, anchor hash, context hash) of runs of starts with one anchor."""
    if len(data) <= RUN + length:
        yield from _run(data, offsets, length, gram)
        return
    # One very long text: stretches that share length - 1 bytes.
    for a in range(0, len(data) - length + 1, RUN):
        own = data[a : a + RUN + length - 1]
        for doc, first, *rest in _run(own, np.array([0, len(own)]), length, gram):
            yield (doc, first + a, *rest)


def _run(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    n = len(data) - length + 1
    if n <= 0:
        return
    rolling = _Rolling(data)
    grams = rolling.of(slice(0, len(data) - gram + 1), slice(gram, len(data) + 1))
    # Later places win among equal hashes: they are the smaller number in the low bits.
    places = np.uint64((1 << 24) - 1) - np.arange(len(grams), dtype=np.uint64)
    least, width, wanted = grams & ~np.uint64((1 << 24) - 1) | places, 1, length - gram + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = wanted - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    anchor = ((1 << 24) - 1 - (least & np.uint64((1 << 24) - 1)).astype(np.int64))[:n]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = np.arange(n) + length <= offsets[doc + 1]
    anchor[~inside] = -1
    key = doc * (len(data) + 1) + anchor
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    counts = np.diff(np.append(heads, n))
    kept = anchor[heads] >= 0
    heads, counts = heads[kept], counts[kept]
    yield (doc[heads], heads - offsets[doc[heads]], counts, grams[anchor[heads]], rolling.of(heads, heads + counts + length - 1))


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return data[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)], ends


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_contexts: int = HOT_CONTEXTS,
            group_bytes: int = GROUP_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with ``n_bytes``, removed ``spans`` (start, end in bytes) and ``kept`` bytes.

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else,
    in the same document or another; strings are judged on the input. Null texts are empty,
    and texts shorter than ``length`` stay whole. Repeated rows are documents of
    their own and so copies of each other. Other columns are left out.
    """
    if not 4 <= gram <= length:
        raise ValueError("a k-gram must fit into a string")
    spark = docs.sparkSession
    ship_package(spark)
    texts, buckets = tables.numbered(tables.ids_of(docs, id_col, text_col), "texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tables.slices(batch, "text", RUN):
                data, offsets = tables.raw(tables.column(part, "text"))
                parts, rows = (np.asarray(tables.column(part, c)) for c in ("part", "row"))
                for doc, first, n, anchor, context in _anchors(data, offsets, length, gram):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(parts[doc]), pa.array(rows[doc]), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)),
                         pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64))],
                        ["part", "row", "first", "n", "anchor", "context"])

    anchors = tables.stored(tables.mapped(texts.select("part", "row", "text"), cut, ANCHORS), "anchors")
    twice = anchors.groupBy("anchor").count().where("count > 1").select("anchor")
    same = ["anchor", "context", "n"]
    shared = tables.stored(anchors.join(twice, "anchor"), "shared-anchors")
    kinds = shared.groupBy(*same).agg(F.count(F.lit(1)).alias("weight"), F.min(F.struct("part", "row", "first")).alias("at"))
    kinds = tables.stored(kinds.select(*same, "weight", "at.*"), "contexts")
    hot = kinds.groupBy("anchor").count().where(F.col("count") > hot_contexts).select("anchor", F.lit(True).alias("hot"))
    total = kinds.agg(F.coalesce(F.sum(F.col("n") + length), F.lit(0))).first()[0]
    groups = max(1, total // group_bytes)
    wanted = kinds.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))

    def sliced(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        data, starts, n, weights = _placed(texts, wanted)
        gathered, ends = _gather(data, starts, n + length - 1)
        return wanted.select([*same, "weight", "hot"]).append_column("bytes", tables.binaries(gathered, ends))

    dealt = wanted.repartition(buckets, "part")
    context_bytes = (texts.select("part", "row", "text").groupBy("part").cogroup(dealt.groupBy("part"))
                     .applyInArrow(sliced, "anchor long, context long, n int, weight long, hot boolean, bytes binary"))
    context_bytes = tables.stored(context_bytes, "context-bytes")

    def expanded(group: pa.Table) -> pa.Table:
        data, offsets = tables.raw(tables.column_of(group, "bytes"))
        strings = [data[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
        found = bwt.repeated_starts(strings, np.asarray(tables.column_of(group, "weight")), length)
        rows = [(i, int(a), int(b)) for i, starts in enumerate(found) for a, b in _true_runs(starts)]
        i, a, b = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
        return pa.table({**{c: tables.column_of(group, c).take(pa.array(i)) for c in same},
                         "a": pa.array(a.astype(np.int32)), "b": pa.array(b.astype(np.int32))})

    runs = "anchor long, context long, n int, a int, b int"
    cold = (context_bytes.where("NOT hot").select(*same, "weight", "bytes")
            .withColumn("_group", F.pmod(F.xxhash64("anchor"), F.lit(groups))).repartition(min(groups, 100_000), "_group")
            .groupBy("_group").applyInArrow(expanded, runs))
    found = cold.unionByName(_hot_runs(context_bytes.where("hot"), length, runs))
    spans = shared.join(found, same).select("part", "row", (F.col("first") + F.col("a")).alias("start"),
                                            (F.col("first") + F.col("b") + (length - 1)).alias("end"))
    spans = spans.repartition(buckets, "part")
    return texts.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(
        _without, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def _placed(texts: pa.Table, wanted: pa.Table) -> tuple[np.ndarray, ...]:
    """All bytes, and where in them each wanted context starts, its starts and weight."""
    order = np.argsort(np.asarray(tables.column_of(texts, "row")), kind="stable")
    data, offsets = tables.raw(tables.column_of(texts, "text"))
    rows = np.asarray(tables.column_of(texts, "row"))[order]
    own = order[np.searchsorted(rows, np.asarray(tables.column_of(wanted, "row")))] if len(rows) else np.zeros(0, np.int64)
    first, n, weight = (np.asarray(tables.column_of(wanted, c)).astype(np.int64) for c in ("first", "n", "weight"))
    return data, offsets[own] + first, n, weight


def _true_runs(flags: np.ndarray) -> zip:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return zip(edges[::2], edges[1::2], strict=True)


def _hot_runs(contexts: DataFrame, length: int, schema: str) -> DataFrame:
    """Repeated starts of the contexts of hot anchors, by counting each string's hash."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tables.slices(batch, "bytes"):
                data, offsets = tables.raw(tables.column(part, "bytes"))
                n = np.asarray(tables.column(part, "n")).astype(np.int64)
                own = np.repeat(np.arange(len(n)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                rolling = _Rolling(data)
                starts = offsets[own] + at
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [tables.column(part, c).take(take) for c in ("anchor", "context", "n", "weight")]
                    + [pa.array(at.astype(np.int32)), pa.array(rolling.of(starts, starts + length).view(np.int64)),
                       pa.array(rolling.of(starts + length // 2, starts + length).view(np.int64))],
                    ["anchor", "context", "n", "weight", "a", "h1", "h2"])

    strings = tables.mapped(contexts.select("anchor", "context", "n", "weight", "bytes"), hashed,
                            "anchor long, context long, n int, weight long, a int, h1 long, h2 long")
    many = strings.groupBy("anchor", "h1", "h2").agg(F.sum("weight").alias("_total")).where("_total > 1").drop("_total")
    return strings.join(many, ["anchor", "h1", "h2"]).select(
        "anchor", "context", "n", "a", (F.col("a") + 1).alias("b"))


def _without(texts: pa.Table, spans: pa.Table) -> pa.Table:
    """Documents of one part without the bytes of their spans."""
    data, offsets = tables.raw(tables.column_of(texts, "text"))
    rows = np.asarray(tables.column_of(texts, "row"))
    order = np.argsort(rows, kind="stable")
    edges = np.zeros(len(data) + 1, np.int64)
    if len(rows) and spans.num_rows:
        own = offsets[order[np.searchsorted(rows[order], np.asarray(tables.column_of(spans, "row")))]]
        np.add.at(edges, own + np.asarray(tables.column_of(spans, "start")), 1)
        np.add.at(edges, own + np.asarray(tables.column_of(spans, "end")), -1)
    gone = np.cumsum(edges)[:-1] > 0
    before = np.concatenate(([False], gone[:-1])) if len(gone) else gone
    doc_starts = offsets[:-1][offsets[:-1] < len(data)]
    if len(gone):
        before[doc_starts] = False
    begins = np.flatnonzero(gone & ~before)
    follows = np.concatenate((gone[1:], [False])) if len(gone) else gone
    lasts = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    if len(gone):
        follows[lasts] = False
    ends = np.flatnonzero(gone & ~follows) + 1
    doc = np.searchsorted(offsets, begins, side="right") - 1
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(doc, np.arange(len(offsets))).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(begins - offsets[doc]), pa.array(ends - offsets[doc])], ["start", "end"]))
    kept = np.concatenate(([0], np.cumsum(~gone)))[offsets]
    return pa.table({"doc_id": tables.column_of(texts, "doc_id"), "n_bytes": pa.array(np.diff(offsets)),
                     "spans": lists, "kept": tables.binaries(data[~gone], kept)})
