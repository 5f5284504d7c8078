"""Best-fit packing of token sequences after dominance reduction.

Items differ only in their length, so the plan is made from the counts per length: at most
``capacity`` numbers, whatever the corpus. The reduction takes the largest length first and
looks for a set of at most three items that fills a sequence at least as well as every other
set with that item could (Martello and Toth's criterion): nothing else fits, one item fills
the rest exactly, one item is as good as every pair, or a pair is as good as every pair. Such
sets become sequences for good, as many at once as their lengths allow. What the criterion
can't settle is packed by best fit, longest first. Every document then finds its place by
its number among those of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from addrwatch.llm import tables, tokens

CAPACITY = 4096
#: Items of one length that are numbered in one group.
GROUP_ROWS = 50_000

PIECES = "row long, doc_id long, piece int, start long, length long, ids binary"
PLACED = "row long, sequence_id long, offset long"


@dataclass
class Pattern:
    """So many sequences alike: (length, copies) from left to right."""

    sequences: int
    parts: tuple[tuple[int, int], ...]


def reduce_counts(counts: np.ndarray) -> list[Pattern]:
    """Takes dominating sets out of counts (index: length; changed in place) until none is left."""
    capacity, fixed = len(counts) - 1, []
    changed = True
    while changed:
        changed = False
        for item in np.flatnonzero(counts)[::-1]:
            while counts[item] and (found := _dominating(counts, int(item), capacity)):
                need = np.bincount(found, minlength=0)
                used = np.flatnonzero(need)
                times = int((counts[used] // need[used]).min())
                counts[used] -= times * need[used]
                fixed.append(Pattern(times, tuple((int(x), int(need[x])) for x in used[::-1])))
                changed = True
    return fixed


def _dominating(counts: np.ndarray, item: int, capacity: int) -> tuple[int, ...] | None:
    """A set with the item that dominates all sets with it, if one of at most three is known to."""
    counts = counts.copy()
    counts[item] -= 1
    room = capacity - item
    sizes = np.flatnonzero(counts[: room + 1])
    if not len(sizes):
        return (item,)
    best = int(sizes[-1])
    smallest = np.repeat(sizes, np.minimum(counts[sizes], 3))[:3]
    if best == room or smallest[:2].sum() > room or len(smallest) < 2:
        return (item, best)
    if len(smallest) > 2 and smallest.sum() <= room:
        return None
    # At most two more items fit.
    twin = np.searchsorted(sizes, room - sizes, side="right") - 1
    pairs = twin >= 0
    left, right = sizes[pairs], sizes[twin[pairs]]
    alone = (left == right) & (counts[left] < 2)
    lower = np.searchsorted(sizes, right[alone], side="left") - 1
    right = right.copy()
    right[alone] = np.where(lower >= 0, sizes[np.maximum(lower, 0)], -capacity)
    if best >= (left + right).max():
        return (item, best)
    counts[best] -= 1
    seconds = np.flatnonzero(counts[: room - best + 1])
    counts[best] += 1
    if not len(seconds):
        return None
    second = int(seconds[-1])
    larger = sizes[sizes > second]
    two = np.repeat(larger, np.minimum(counts[larger], 2))[:2]
    return (item, best, second) if len(two) < 2 or two.sum() > room else None


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Longest items first, each into the sequence with the least room that takes it."""
    capacity = len(counts) - 1
    rooms: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    open_rooms = np.zeros(capacity + 1, bool)

    def put(room: int, pattern: Pattern) -> None:
        rooms[room].append(pattern)
        open_rooms[room] = True

    for size in map(int, np.flatnonzero(counts)[::-1]):
        left = int(counts[size])
        while left:
            wide = np.flatnonzero(open_rooms[size:])
            room = size + int(wide[0]) if len(wide) else capacity
            pattern = rooms[room].pop() if len(wide) else Pattern(left, ())
            open_rooms[room] = bool(rooms[room])
            copies = min(room // size, left)
            used = min(pattern.sequences, left // copies)
            if used < pattern.sequences and pattern.parts:
                put(room, Pattern(pattern.sequences - used, pattern.parts))
            put(room - copies * size, Pattern(used, (*pattern.parts, (size, copies))))
            left -= used * copies
    return [p for group in rooms for p in group]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Sequences for so many items of each length from 1 to capacity."""
    table = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} is not within 1 and {capacity}")
        table[length] = n
    fixed = reduce_counts(table)
    return fixed + best_fit(table)


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Runs of places by length and number within the length.

    The number of runs follows the capacity, not the corpus: every step of the plan uses up a
    length or a group of open sequences, and a sequence has at most about the root of twice
    the capacity of different lengths.
    """
    runs, taken, base = [], {}, 0
    for p in patterns:
        offset = 0
        for length, copies in p.parts:
            first = taken.get(length, 0)
            runs.append((length, first, copies, base, offset))
            taken[length] = first + p.sequences * copies
            offset += length * copies
        base += p.sequences
    runs.sort()
    values = np.array(runs, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "copies", "base", "offset"), values, strict=True))


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids with an end id, cut every ``capacity`` ids, in a stored table.

    Null texts count as empty and give the end id alone; repeated rows and null identifiers
    are documents of their own (``row`` tells them apart); other columns are left out.
    """
    docs = tables.ids_of(docs, id_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokens.tokenizer(tokenizer_path).ids
        end = np.array([end_id], dtype="<u4").tobytes()
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in tables.slices(batch, "text"):
                out = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = ids_of(text) + end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        out.append((row, doc, piece, at // 4, len(own) // 4, own))
                        row += 1
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["row", "doc_id", "piece", "start", "length", "ids"])

    return tables.stored(tables.mapped(docs, cut, PIECES), "pieces")


def pack(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Place of every item: its row with ``sequence_id`` and ``offset``.

    items: a stored table with a unique ``row`` and a ``length`` of 1 to capacity. Lengths
    with many items are numbered in groups chosen by a hash of the row, so no length is
    gathered in one task. An empty table gives an empty table.
    """
    counts = items.groupBy("length").count()  # at most capacity rows
    found = {r["length"]: r["count"] for r in counts.collect()}
    spark = items.sparkSession
    table = spark.sparkContext.broadcast(places(plan(found, capacity)))
    groups = spark.createDataFrame([(k, -(-n // group_rows)) for k, n in found.items()], "length long, _groups int")
    dealt = (items.join(F.broadcast(groups), "length")
             .withColumn("_group", F.pmod(F.xxhash64("row"), F.col("_groups")).cast("int")).drop("_groups"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_group").orderBy("row")
    ranked = (dealt.withColumn("_rank", F.row_number().over(own).cast("long"))
              .join(starts, ["length", "_group"])
              .withColumn("_rank", F.col("_rank") - 1 + F.col("_before")).drop("_group", "_before"))
    names = [c for c in ranked.columns if c != "_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = table.value
        keys = (runs["length"] << 44) + runs["first"]
        for batch in batches:
            length, rank = (np.asarray(tables.column(batch, c)) for c in ("length", "_rank"))
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            nth = rank - runs["first"][at]
            copies = runs["copies"][at]
            yield pa.RecordBatch.from_arrays(
                [*(tables.column(batch, c) for c in names), pa.array(runs["base"][at] + nth // copies),
                 pa.array(runs["offset"][at] + nth % copies * length)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {t}" for n, t in ranked.select(*names).dtypes)
    return tables.mapped(ranked, place, f"{schema}, sequence_id long, offset long")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``length`` and the ids as little-endian bytes."""
    parts = pieces.select("row", "ids").join(placed.select("row", "sequence_id", "offset", "length"), "row")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(ordered, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
