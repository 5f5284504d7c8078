"""Exact nearest binary codes by incremental multi-index hashing.

A code is the signs of a vector. Codes are cut into segments, each with an index from its value to
the codes that have it. If two codes differ in at most m (r + 1) - 1 bits, one of their m segments
differs in at most r. So a search looks up all values within radius r of its own segments, r from 0 on,
verifies what it finds, and ends once the distance of its k-th best is covered by that bound.

The codes are dealt to tasks in parts, each with indexes of its own; queries go to all parts in blocks
of bounded size, and the k best of every part are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from addrwatch.llm import tables

#: Codes in a part, and queries sent to all parts at a time (8 bytes of identifier and the code each).
PART_ROWS = 16_384
BLOCK_QUERIES = 500_000


class Index:
    """Segment indexes over packed codes."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, bits: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.codes = ids[order], codes[order]
        width = int(np.clip(np.log2(max(len(ids), 2)), 4, 16))
        self.cuts = np.array_split(np.arange(bits), max(1, -(-bits // width)))
        self.tables = []
        for values, cut in zip(self.segments(self.codes), self.cuts, strict=True):
            by_value = np.argsort(values, kind="stable")
            self.tables.append((by_value, np.searchsorted(values[by_value], np.arange((1 << len(cut)) + 1))))
        self.masks = {}
        for size in {len(c) for c in self.cuts}:
            flips = np.bitwise_count(np.arange(1 << size, dtype=np.uint32))
            self.masks[size] = [np.flatnonzero(flips == r) for r in range(size + 1)]

    def segments(self, codes: np.ndarray) -> list[np.ndarray]:
        bits = np.unpackbits(codes, axis=1)
        return [bits[:, cut].astype(np.int64) @ (1 << np.arange(len(cut))) for cut in self.cuts]

    def nearest(self, code: np.ndarray, segments: list[int], own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers, distances) of the k nearest codes but the query's own row, by distance, then identifier."""
        seen = np.zeros(len(self.ids), bool)
        seen[np.searchsorted(self.ids, own_id, "left") : np.searchsorted(self.ids, own_id, "right")] = True
        best, distance = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(max(map(len, self.cuts)) + 1):
            for (by_value, starts), value, cut in zip(self.tables, segments, self.cuts, strict=True):
                if radius > len(cut):
                    continue
                near = value ^ self.masks[len(cut)][radius]
                a, n = starts[near], starts[near + 1] - starts[near]
                at = by_value[np.arange(n.sum()) + np.repeat(a - (np.cumsum(n) - n), n)]
                at = at[~seen[at]]
                seen[at] = True
                best = np.concatenate((best, at))
                distance = np.concatenate((distance, np.bitwise_count(self.codes[at] ^ code).sum(axis=1, dtype=np.int64)))
            order = np.lexsort((self.ids[best], distance))[:k]
            best, distance = best[order], distance[order]
            if len(best) == k and distance[-1] <= len(self.cuts) * (radius + 1) - 1:
                break
        return self.ids[best], distance


def sign_codes(vectors: DataFrame, bits: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code) of vectors with ``bits`` numbers: bit 1 where a number is above 0.

    Null vectors, vectors of another length and null identifiers are left out; nulls and
    NaN inside a vector give bit 0.
    """
    plain = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    plain = plain.where((F.size("v") == bits) & F.col("id").isNotNull())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(pc.fill_null(tables.column(batch, "v").flatten(), 0.0)).reshape(-1, bits)
            packed = np.packbits(values > 0, axis=1)
            codes = tables.binaries(packed.ravel(), np.arange(len(packed) + 1) * packed.shape[1])
            yield pa.RecordBatch.from_arrays([tables.column(batch, "id"), codes], ["id", "code"])

    return tables.stored(tables.mapped(plain, coded, "id long, code binary"), "codes")


def nearest(codes: DataFrame, queries: Column, k: int, bits: int, part_rows: int = PART_ROWS,
            block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest codes of each query by Hamming distance.

    queries: a condition on ``id`` that says which rows of the stored codes are queries. A row isn't its own
    neighbour, nor are others with its identifier; equal distances go by identifier. A
    repeated identifier counts as a neighbour each time it occurs and gives one query. With fewer than k other codes
    all of them are returned.
    """
    asked = codes.where(queries).dropDuplicates(["id"])
    total, rows = asked.count(), codes.count()
    blocks = max(1, -(-total // block_queries))
    parts = max(1, -(-rows // part_rows))
    dealt = codes.repartition(parts, F.xxhash64("id", "code"))
    found = []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toPandas()  # at most about block_queries
        packed = np.frombuffer(b"".join(own["code"]), np.uint8).reshape(len(own), -(-bits // 8))
        shared = codes.sparkSession.sparkContext.broadcast((own["id"].to_numpy(np.int64), packed))

        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = list(batches)
            ids = np.concatenate([np.zeros(0, np.int64), *(np.asarray(tables.column(b, "id")) for b in held)])
            if not len(ids):
                return
            own = np.concatenate([tables.raw(tables.column(b, "code"))[0] for b in held]).reshape(len(ids), -1)
            index = Index(ids, own, bits)
            asked_ids, asked_codes = shared.value
            for a in range(0, len(asked_ids), 1024):
                segments = [s.tolist() for s in index.segments(asked_codes[a : a + 1024])]
                out = [index.nearest(c, list(s), i, k) for i, c, *s in
                       zip(asked_ids[a : a + 1024].tolist(), asked_codes[a : a + 1024], *segments, strict=True)]
                counts = [len(x) for x, _ in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(asked_ids[a : a + 1024], counts)), *(pa.array(np.concatenate(x)) for x in zip(*out, strict=True))],
                    ["query_id", "neighbor_id", "distance"])

        found.append(tables.mapped(dealt, searched, "query_id long, neighbor_id long, distance long"))
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "neighbor_id", "distance")
