"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with a cosine of at least t lie within a squared distance of 2 (1 - t). All vectors are turned by one
rotation, which spreads distances evenly, and cut into blocks of few dimensions. If a pair keeps the whole budget, it keeps
a block's share of it in at least one block; so a range join runs in every block under a share in proportion to the block's
dimensions, and what any of them finds is verified on whole vectors.

The range join of a block: a tree of cuts, chosen on a bounded sample, has leaves of bounded expected size. A vector
has one home leaf and visits the later leaves whose box is within the budget, so that a pair in reach meets in exactly
one leaf. Leaves that hold more rows than planned are cut into chunks, and tasks take two chunks each. A pair counts in
the first block that finds it. Tasks return a number of links per vector and links that span what is connected, never
pairs, so their results grow with the vectors of a leaf, not with its links.

Equal vectors are one node with a number of copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from addrwatch.llm import components, tables

#: Dimensions of a block.
WIDTH = 16
#: Rows that a leaf should hold at home, rows of a chunk, and rows per comparison.
LEAF_ROWS, CHUNK_ROWS, TILE_ROWS = 32_768, 65_536, 512
#: Sampled vectors per leaf, and the bounds of the sample that the trees are chosen on.
SAMPLED_PER_LEAF, SAMPLE_ROWS = 64, (4_096, 65_536)
#: A cut that more than this share of the rows would have to cross isn't made.
CROSSING = 0.9
#: Far above the rounding of sums over double and single components of unit vectors.
SLACK, SINGLE_SLACK = 1e-9, 1e-5


@dataclass
class Leaf:
    number: int = 0


@dataclass
class Cut:
    place: int
    value: float
    low: Cut | Leaf
    high: Cut | Leaf


@dataclass
class Space:
    """How vectors become rotated unit vectors, and what two of them may differ by in a block."""

    dimensions: int
    threshold: float
    signs: list[np.ndarray] = field(init=False)
    blocks: list[slice] = field(init=False)

    def __post_init__(self):
        size = 1 << max(0, int(self.dimensions - 1).bit_length())
        rng = np.random.default_rng(12)
        self.signs = [rng.choice([-1.0, 1.0], size) for _ in range(3)]
        width = min(WIDTH, size)
        self.blocks = [slice(a, a + width) for a in range(0, size, width)]

    @property
    def budget(self) -> float:
        """A block's share of the squared distance; all blocks have the same number of dimensions."""
        return 2 * (1 - self.threshold) / len(self.blocks) + SLACK

    def units(self, vectors: np.ndarray) -> np.ndarray:
        """Unit vectors, padded by zeros. Like the rotation, number by number: a row's result doesn't depend on its batch."""
        padded = np.zeros((len(vectors), len(self.signs[0])))
        padded[:, : vectors.shape[1]] = vectors
        largest = np.abs(padded).max(axis=1, initial=0)
        padded /= np.where(largest > 0, largest, 1)[:, None]
        norm = np.zeros(len(padded))
        for place in range(padded.shape[1]):
            norm += padded[:, place] ** 2
        return padded / np.sqrt(np.where(norm > 0, norm, 1))[:, None]

    def rotated(self, units: np.ndarray) -> np.ndarray:
        """Three rounds of random signs and a Hadamard transform."""
        n, size = units.shape
        for signs in self.signs:
            units = units * signs
            half = 1
            while half < size:
                pairs = units.reshape(n, size // (2 * half), 2, half)
                units = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, size)
                half *= 2
            units = units / np.sqrt(size)
        return units


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances row by row, added in one fixed order."""
    total = np.zeros(len(left))
    for place in range(left.shape[1]):
        total += (left[:, place] - right[:, place]) ** 2
    return total


def grown(points: np.ndarray, budget: float, rows: float) -> Cut | Leaf:
    """A tree of cuts over sampled points of a block that stand for so many rows; leaves are numbered from left to right."""
    reach = np.sqrt(budget)

    def grow(points: np.ndarray, rows: float) -> Cut | Leaf:
        if rows <= LEAF_ROWS or len(points) < SAMPLED_PER_LEAF:
            return Leaf()
        best = (CROSSING, 0, 0.0)
        for share in (0.35, 0.5, 0.65):
            values = np.quantile(points, share, axis=0, method="nearest")
            crossing = (np.abs(points - values) <= reach).mean(axis=0)
            place = int(np.argmin(crossing))
            best = min(best, (float(crossing[place]), place, float(values[place])))
        crossing, place, value = best
        low = points[:, place] < value
        if crossing >= CROSSING or not low.any() or low.all():
            return Leaf()
        return Cut(place, value, grow(points[low], rows * low.mean()), grow(points[~low], rows * (1 - low.mean())))

    tree, number = grow(points, rows), 0
    stack = [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, Leaf):
            node.number, number = number, number + 1
        else:
            stack += [node.high, node.low]
    return tree


def homes(tree: Cut | Leaf, points: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(points), np.int64)
    stack = [(tree, np.arange(len(points)))]
    while stack:
        node, at = stack.pop()
        if isinstance(node, Leaf):
            leaf[at] = node.number
        elif len(at):
            low = points[at, node.place] < node.value
            stack += [(node.low, at[low]), (node.high, at[~low])]
    return leaf


def visits(tree: Cut | Leaf, points: np.ndarray, home: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for every leaf after the row's own whose box is within the budget."""
    rows, leaves = [], []
    stack = [(tree, np.arange(len(points)), np.zeros(points.shape))]
    while stack:
        node, at, gaps = stack.pop()
        if not len(at):
            continue
        if isinstance(node, Leaf):
            later = node.number > home[at]
            rows.append(at[later])
            leaves.append(np.full(int(later.sum()), node.number))
            continue
        away = points[at, node.place] - node.value
        for child, outside in ((node.low, away >= 0), (node.high, away < 0)):
            own = gaps.copy()
            own[:, node.place] = np.where(outside, np.maximum(own[:, node.place], np.abs(away)), own[:, node.place])
            near = (own ** 2).sum(axis=1) <= budget + SLACK
            stack.append((child, at[near], own[near]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *leaves])


class Spanning:
    """Which of n rows are connected, kept as the least row of each set."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            a, b = self.of[left], self.of[right]
            open_links = a != b
            if not open_links.any():
                return
            left, right = left[open_links], right[open_links]
            low, high = np.minimum(a, b)[open_links], np.maximum(a, b)[open_links]
            np.minimum.at(self.of, high, low)
            while True:
                further = self.of[self.of]
                if (further == self.of).all():
                    break
                self.of = further


def joined(space: Space, block: int, units: np.ndarray, copies: np.ndarray, home: np.ndarray, first: np.ndarray,
           alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """(links of every row, least row connected to it) for the pairs that a leaf's two chunks have in reach.

    first: rows of the first chunk, which meet the others; alone: there is one chunk, whose rows meet each other. Two
    visitors meet in another leaf.
    """
    turned = space.rotated(units)
    own = turned[:, space.blocks[block]]
    # left . right is minus half the squared distance; candidates are then compared in doubles.
    half, one = (own**2).sum(axis=1, keepdims=True) / -2, np.ones((len(own), 1))
    lefts_of, rights_of = (np.concatenate(x, axis=1).astype(np.float32) for x in ((own, half, one), (own, one, half)))
    least = -(space.budget + SINGLE_SLACK) / 2
    count, spanning = np.zeros(len(units), np.int64), Spanning(len(units))
    for left_home, right_home in ((True, True), (True, False), (False, True)):
        if alone and not left_home:
            continue
        lefts = np.flatnonzero(first & (home == left_home))
        rights = np.flatnonzero((first if alone else ~first) & (home == right_home))
        for a in range(0, len(lefts), TILE_ROWS):
            left = lefts[a : a + TILE_ROWS]
            for b in range(a if alone and right_home else 0, len(rights), 4 * TILE_ROWS):
                right = rights[b : b + 4 * TILE_ROWS]
                i, j = np.nonzero(lefts_of[left] @ rights_of[right].T >= least)
                i, j = left[i], right[j]
                if alone and right_home:
                    i, j = i[i < j], j[i < j]
                for c in range(0, len(i), 1 << 16):
                    p, q = i[c : c + (1 << 16)], j[c : c + (1 << 16)]
                    linked = np.einsum("ij,ij->i", units[p], units[q]) >= space.threshold
                    p, q = p[linked], q[linked]
                    counts = squared(own[p], own[q]) <= space.budget
                    for earlier in space.blocks[:block]:
                        counts &= squared(turned[p][:, earlier], turned[q][:, earlier]) > space.budget
                    p, q = p[counts], q[counts]
                    np.add.at(count, p, copies[q])
                    np.add.at(count, q, copies[p])
                    spanning.add(p, q)
    return count, spanning.of


def _matrix(vectors: pa.Array, kind: str, dimensions: int) -> np.ndarray:
    """Vectors kept as bytes, as rows padded to the number of dimensions."""
    data, offsets = tables.raw(vectors)
    values, ends = data.view(kind).astype(np.float64), offsets // np.dtype(kind).itemsize
    lengths = np.diff(ends)
    out = np.zeros((len(lengths), dimensions))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(ends[:-1], lengths)] = values
    return out


def _marked(vectors: DataFrame, kind: str) -> DataFrame:
    """(id, dims, mark, vec): the vector's bytes and a digest of them; null where it can't link."""
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = tables.column(batch, "v")
            values = np.asarray(lists.flatten(), dtype=kind) + np.zeros((), kind)  # -0.0 becomes 0.0
            ends = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64))))
            held = values.tobytes()
            size = np.dtype(kind).itemsize
            vecs = [held[size * a : size * b] or None for a, b in zip(ends[:-1], ends[1:], strict=True)]
            marks = [v and hashlib.sha256(v).digest() for v in vecs]
            yield pa.RecordBatch.from_arrays(
                [tables.column(batch, "id"), pa.array(np.diff(ends).astype(np.int32)), pa.array(marks, pa.binary()), pa.array(vecs, pa.binary())],
                ["id", "dims", "mark", "vec"])

    return tables.mapped(vectors, marked, f"id {vectors.schema['id'].dataType.simpleString()}, dims int, mark binary, vec binary")


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: other rows with a cosine of at least the threshold, and the
    least identifier reachable by links.

    Null, empty and zero vectors and those with null, infinite or NaN components link with nothing and are components of their
    own, and so do vectors of different lengths with each other. Repeated rows are rows of their own, linked with each other; a null identifier is never the
    least one unless its component has no other. Rows of a null identifier alone have component null and kept null. Other columns aren't read.
    """
    spark = vectors.sparkSession
    single = "array<float>" in vectors.schema[vector_col].dataType.simpleString()
    element, kind = ("float", "<f4") if single else ("double", "<f8")
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("v"))
    rows = rows.withColumn("v", F.when(finite & F.exists(v, lambda x: x != 0), v))
    rows = tables.stored(_marked(rows, kind), "vectors")

    nodes = rows.where("mark IS NOT NULL").groupBy("mark").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("dims").alias("dims"), F.first("vec").alias("vec"))
    nodes = tables.stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    total, dimensions = nodes.agg(F.count(F.lit(1)), F.coalesce(F.max("dims"), F.lit(1))).first()
    space = Space(dimensions, threshold)
    found = tables.stored(_found(spark, nodes, space, kind, total), "found")

    number = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components.connected(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    placed = nodes.select("node", "mark", "least", "copies").join(number, "node", "left").join(reached, "node", "left")
    placed = tables.stored(placed.withColumn("component", F.coalesce("component", "node")), "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(least, "component").select("mark", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = F.col("mark").isNull()
    joined_rows = rows.select("id", "mark").join(placed, "mark", "left")
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return joined_rows.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("id") == component).alias("kept"))


def _found(spark, nodes: DataFrame, space: Space, kind: str, total: int) -> DataFrame:
    """(node, links, other): a node's links in one meeting of two chunks, and a node it is connected to there."""
    low, high = SAMPLE_ROWS
    size = min(max(low, total // LEAF_ROWS * SAMPLED_PER_LEAF), high)
    sample = nodes.orderBy(F.xxhash64("mark"), "mark").limit(size).select("vec").toArrow()  # at most SAMPLE_ROWS
    points = space.rotated(space.units(_matrix(tables.column_of(sample, "vec"), kind, space.dimensions)))
    trees = [grown(points[:, b], space.budget, total) for b in space.blocks]
    shared = spark.sparkContext.broadcast((space, trees))

    def placed(batch: pa.RecordBatch) -> Iterator[tuple]:
        """(block, row, leaf, at home) of a batch, block by block."""
        space, trees = shared.value
        turned = space.rotated(space.units(_matrix(tables.column(batch, "vec"), kind, space.dimensions)))
        for block, (tree, part) in enumerate(zip(trees, space.blocks, strict=True)):
            home = homes(tree, turned[:, part])
            row, leaf = visits(tree, turned[:, part], home, space.budget)
            yield (block, np.concatenate((np.arange(len(home)), row)), np.concatenate((home, leaf)),
                   np.arange(len(home) + len(row)) < len(home))

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(tables.column(batch, "dims"))
            for block, row, leaf, _ in placed(batch):
                keys, n = np.unique(np.stack((dims[row], leaf)), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[0].astype(np.int32)), pa.array(np.full(len(n), block, np.int32)), pa.array(keys[1].astype(np.int32)), pa.array(n)],
                    ["dims", "block", "leaf", "n"])

    sizes = tables.mapped(nodes.select("dims", "vec"), sized, "dims int, block int, leaf int, n long")
    large = sizes.groupBy("dims", "block", "leaf").agg(F.sum("n").alias("n")).where(F.col("n") > CHUNK_ROWS).collect()  # of the trees' leaves
    chunks = spark.sparkContext.broadcast({(r["dims"], r["block"], r["leaf"]): -(-r["n"] // CHUNK_ROWS) for r in large})

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(tables.column(batch, "dims"))
            node = np.asarray(tables.column(batch, "node"))
            for block, row, leaf, home in placed(batch):
                keys, inverse = np.unique(np.stack((dims[row], leaf)), axis=1, return_inverse=True)
                parts = np.array([chunks.value.get((int(d), block, int(x)), 1) for d, x in keys.T], np.int64)[inverse.ravel()]
                own = (node[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).astype(np.int64) % np.maximum(parts, 1)
                again = np.repeat(np.arange(len(row)), parts)
                other = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
                mine = own[again]
                out = batch.select(["node", "copies", "dims", "vec"])
                for a in range(0, len(again), TILE_ROWS):
                    cut = slice(a, a + TILE_ROWS)
                    base = out.take(pa.array(row[again[cut]]))
                    extra = (np.full(len(base), block), leaf[again[cut]], np.minimum(mine, other)[cut], np.maximum(mine, other)[cut], mine[cut])
                    yield pa.RecordBatch.from_arrays(
                        [*base.columns, *(pa.array(x.astype(np.int32)) for x in extra), pa.array(home[again[cut]])],
                        ["node", "copies", "dims", "vec", "block", "leaf", "low", "high", "chunk", "home"])

    def met(key: tuple, rows: pa.Table) -> pa.Table:
        space, _ = shared.value
        units = space.units(_matrix(tables.column_of(rows, "vec"), kind, space.dimensions))
        home, chunk = (tables.column_of(rows, c).to_numpy(zero_copy_only=False) for c in ("home", "chunk"))
        node, copies = (np.asarray(tables.column_of(rows, c)) for c in ("node", "copies"))
        low, high, block = key[2].as_py(), key[3].as_py(), key[1].as_py()
        count, least = joined(space, block, units, copies, home, chunk == low, low == high)
        linked = count > 0
        return pa.table({"node": node[linked], "links": count[linked], "other": node[least][linked]})

    many = tables.mapped(nodes.select("node", "copies", "dims", "vec"), dealt,
                         "node long, copies long, dims int, vec binary, block int, leaf int, low int, high int, chunk int, home boolean")
    return many.groupBy("dims", "block", "low", "high", "leaf").applyInArrow(met, "node long, links long, other long")
