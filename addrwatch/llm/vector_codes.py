"""Vector code compression: parts of vectors become numbers of codebook entries, found with a GNAT over the entries.

Vectors become integers and are cut into parts; each part position has a codebook that a few rounds of assignment and
averaging improve. The nearest entry is exact: by integer squared distance, ties to the lower number.

A GNAT (geometric near-neighbour access tree) over the entries has split points; every other entry belongs to the child of
its nearest split point, and a child keeps the range of its entries' distances to each split point. A
search knows its distances to the split points and the best distance so far. If, for any split point, the ring that the
best distance allows lies strictly outside the child's range, the child can't hold an entry as near, and its whole subtree
goes. Distances in these tests are square roots rounded away from elimination; every entry that is left is
compared by integers, so ties are seen.

All vectors of a batch descend together. A round is one job: tasks return sums and counts per entry, Spark adds
them up, and the driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from addrwatch.llm import tables

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node, and entries that are compared without a further split.
SPLITS, LEAF_ENTRIES = 16, 8
#: Integers beyond what a long adds up safely are summed in digits of so many bits.
DIGIT = 30
LARGEST = (1 << 63) - 1


def number_kind(largest: int, width: int) -> type:
    """The fastest type in which squared distances of such integers are exact: doubles, longs or Python's integers."""
    bound = 4 * max(largest, 1) ** 2 * max(width, 1)
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    if points.dtype == np.float64:  # whole numbers below two to the power 53 in every sum
        return (points**2).sum(axis=1)[:, None] + (entries**2).sum(axis=1) - 2 * points @ entries.T
    total = np.zeros((len(points), len(entries)), points.dtype)
    for place in range(points.shape[1]):
        total += (points[:, place, None] - entries[:, place]) ** 2
    return total


def below(square: np.ndarray) -> np.ndarray:
    """At most the square root."""
    return np.sqrt(square.astype(np.float64)) * (1 - 1e-15)


def above(square: np.ndarray) -> np.ndarray:
    """At least the square root."""
    return np.sqrt(square.astype(np.float64)) * (1 + 1e-15)


@dataclass
class Node:
    """Split points, what the children hold, and each child's distance ranges: (split point, child)."""

    splits: np.ndarray
    children: list[Node | np.ndarray]
    least: np.ndarray
    most: np.ndarray


class Gnat:
    """A GNAT over the entries of a codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._node(np.arange(len(entries)))

    def _node(self, own: np.ndarray) -> Node | np.ndarray:
        if len(own) <= LEAF_ENTRIES:
            return own
        between = distances(self.entries[own], self.entries[own])
        # Each split point is the entry farthest from those before it.
        splits, nearest = [0], between[0]
        while len(splits) < min(SPLITS, len(own) // 2):
            splits.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, between[splits[-1]])
        splits = np.array(sorted(set(splits)))
        owner = np.argmin(between[:, splits].astype(np.float64), axis=1)
        owner[splits] = -1
        groups = [np.flatnonzero(owner == c) for c in range(len(splits))]
        low, high = (np.zeros((len(splits), len(splits))) for _ in range(2))
        for c, group in enumerate(groups):
            if len(group):
                ranges = between[np.ix_(splits, group)]
                low[:, c], high[:, c] = below(ranges.min(axis=1)), above(ranges.max(axis=1))
        # Only entries equal to a split point can leave a group as large as its node.
        return Node(own[splits], [self._node(own[g]) if len(g) < len(own) - len(splits) or len(splits) > 1 else own[g] for g in groups], low, high)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of every point, and how many distances were taken."""
        self._best = np.full(len(points), len(self.entries))
        self._distance = np.full(len(points), 0, points.dtype)
        self._taken = 0
        if len(points) and len(self.entries):
            self._search(self.root, points, np.arange(len(points)))
        return self._best, self._distance, self._taken

    def _compare(self, points: np.ndarray, at: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Lets the entries compete for the points, and returns their squared distances."""
        found = distances(points[at], self.entries[own])
        self._taken += found.size
        column = np.argmin(found, axis=1)  # the first of equals, and entries are in ascending order
        square, entry = found[np.arange(len(at)), column], own[column]
        unknown = self._best[at] == len(self.entries)
        better = unknown | (square < self._distance[at]) | (square == self._distance[at]) & (entry < self._best[at])
        self._best[at[better]], self._distance[at[better]] = entry[better], square[better]
        return found

    def _search(self, node: Node | np.ndarray, points: np.ndarray, at: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            if len(node) and len(at):
                self._compare(points, at, node)
            return
        found = self._compare(points, at, node.splits)
        first = np.argmin(found.astype(np.float64), axis=1)
        low, high = below(found), above(found)
        for own_child in (True, False):  # the nearest split point's child first, for a good bound on the others
            for c, child in enumerate(node.children):
                rows = np.flatnonzero((first == c) == own_child)
                if not len(rows) or isinstance(child, np.ndarray) and not len(child):
                    continue
                reach = above(self._distance[at[rows]])[:, None]
                beyond = np.nextafter(low[rows] - reach, -np.inf) > node.most[:, c]
                short = np.nextafter(high[rows] + reach, np.inf) < node.least[:, c]
                rows = rows[~(beyond | short).any(axis=1)]
                if len(rows):
                    self._search(child, points, at[rows])


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """The rows (vec_id, label, code, error) of kept vectors, and the codebook of each part position.

    Rows go whose vector is null or holds null or non-finite components, and rows whose vector hasn't the length of that with
    the smallest identifier. Codebooks begin with the smallest identifiers, a null one last, equal
    ones by vector; with fewer rows they are smaller. Repeated rows count each time. If the length isn't a multiple of
    ``parts``, the first parts are longer by one. An error beyond a long is given as the largest long. An empty table has no rows and empty
    codebooks. Other columns aren't read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = tables.stored(rows, "kept")
    start = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    if not start:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), [np.zeros((0, 0))] * parts
    width = len(start[0]["v"])
    rows = rows.where(F.size("v") == width)
    start = [r["v"] for r in start if len(r["v"]) == width]
    cuts = [(int(c[0]), int(c[-1]) + 1) if len(c) else (0, 0) for c in np.array_split(np.arange(width), parts)]
    largest = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    kind = number_kind(int(largest * SCALE) + 1 if largest < 1e300 else int(largest) * SCALE + 1, -(-width // parts))
    digits = 1 if kind is not object else -(-(int(largest) * SCALE + 1).bit_length() // DIGIT) + 1

    whole = _integers(np.array(start, np.float64).reshape(len(start), width), kind)
    books = [whole[:, a:b] for a, b in cuts]
    for _ in range(rounds):
        books = _averaged(spark, rows, books, cuts, kind, digits)
    return _coded(spark, rows, books, cuts, kind), books


def digest(books: list[np.ndarray]) -> str:
    """The hexadecimal SHA-256 of all entries' components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for entry in book for x in entry).encode()).hexdigest()


def _integers(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return np.floor(values * SCALE).astype(kind)
    # A scale of two to the power 10 changes the exponent alone; Python's integers have no largest one.
    return np.array([[(n * SCALE) // d for n, d in map(float.as_integer_ratio, row)] for row in values.tolist()], object).reshape(values.shape)


def _assigned(batch: pa.RecordBatch, trees: list[Gnat], cuts: list[tuple[int, int]], kind: type) -> Iterator[tuple]:
    """(part, its integers, entry, squared distance) of a batch of vectors."""
    values = np.asarray(tables.column(batch, "v").flatten()).reshape(batch.num_rows, max(b for _, b in cuts))
    whole = _integers(values, kind)
    for part, (tree, (a, b)) in enumerate(zip(trees, cuts, strict=True)):
        yield part, whole[:, a:b], *tree.nearest(whole[:, a:b])[:2]


def _averaged(spark, rows: DataFrame, books: list[np.ndarray], cuts: list[tuple[int, int]], kind: type, digits: int) -> list[np.ndarray]:
    """Every entry replaced by the floor of the average of the parts assigned to it; entries without parts stay."""
    shared = spark.sparkContext.broadcast(books)
    width = max(b - a for a, b in cuts)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in shared.value]
        exact = object if kind is object else np.int64
        sums = np.zeros((len(trees), len(trees[0].entries), width), exact)
        counts = np.zeros(sums.shape[:2], np.int64)
        for batch in batches:
            for part, own, entry, _ in _assigned(batch, trees, cuts, kind):
                order = np.argsort(entry, kind="stable")
                used, first, n = np.unique(entry[order], return_index=True, return_counts=True)
                if own.shape[1]:
                    sums[part, used, : own.shape[1]] += np.add.reduceat(own[order].astype(exact), first, axis=0)
                counts[part, used] += n
        part, entry = np.nonzero(counts)
        if len(part):
            total = sums[part, entry]
            last = [(total >> DIGIT * d) & ((1 << DIGIT) - 1) for d in range(digits - 1)] + [total >> DIGIT * (digits - 1)]
            listed = pa.array(np.stack(last, axis=2).reshape(len(part), -1).astype(np.int64).tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), listed],
                ["part", "entry", "n", "sums"])

    partial = tables.mapped(rows.select("v"), summed, "part int, entry int, n long, sums array<long>")
    places = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width * digits)]
    totals = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *places).collect()  # a row per entry
    after = [book.copy() for book in books]
    for row in totals:
        own = np.array(row[3:], object).reshape(width, digits)
        for place in range(after[row["part"]].shape[1]):
            total = sum(int(x) << DIGIT * d for d, x in enumerate(own[place]))
            after[row["part"]][row["entry"], place] = total // row["n"]
    return after


def _coded(spark, rows: DataFrame, books: list[np.ndarray], cuts: list[tuple[int, int]], kind: type) -> DataFrame:
    shared = spark.sparkContext.broadcast(books)
    label, ident = (rows.schema[c].dataType.simpleString() for c in ("label", "vec_id"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in shared.value]
        for batch in batches:
            codes, errors = np.zeros((batch.num_rows, len(trees)), np.int64), np.zeros(batch.num_rows, object)
            for part, _, entry, square in _assigned(batch, trees, cuts, kind):
                codes[:, part] = entry
                errors += square.astype(object)
            texts = ["".join(f"{x:02x}" for x in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [tables.column(batch, "vec_id"), tables.column(batch, "label"), pa.array(texts, pa.string()),
                 pa.array([min(int(x), LARGEST) for x in errors], pa.int64())],
                ["vec_id", "label", "code", "error"])

    return tables.mapped(rows.select("vec_id", "label", "v"), coded, f"vec_id {ident}, label {label}, code string, error long")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """The rows with label_error, the errors of all rows of a label; null is a label. Sums beyond a long become the largest long."""
    coded = tables.stored(coded, "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
