"""Removal of lines that repeat an earlier line of the corpus exactly or within a few edits.

Lines are joined by edit distance with segment partitioning. A line is cut into threshold + 1
segments; a line within the threshold of it contains one of them unchanged, near its place.
So every line goes into an index under (its length, segment number, segment), and probes the
indexes of its own and slightly smaller lengths with those of its substrings that can match
in a cheapest alignment. Lines that meet are verified by a banded bit-parallel edit distance.

Within a bucket of at most PAIRED lines all pairs with an indexed line are verified. In a larger one,
as a frequent segment makes it, lines are placed by where they begin to differ from the first
one, and only those are compared that differ in places near enough (``_measured``); many
lines that begin to differ in one place are a bucket of their own. A task divides buckets of at
most HERE lines to the end (``_divided``); larger ones are divided by joins, round by round. Every pair of different lines within the
threshold is found in the bucket of the least key they share, and counted there once.
"""

from __future__ import annotations

import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from addrwatch.llm import components, tables, words
from addrwatch.session import ship_package

#: Edits (insertions, deletions, substitutions of a code point) within which lines are linked.
THRESHOLD = 2
#: Shorter lines are compared exactly only: a few edits would link unrelated ones.
MIN_CHARS = 20
PAIRED = 32
#: Lines of a bucket that one task divides.
HERE = 2048
#: Lines that are verified against one line in a task.
GROUP = 512
#: Pairs that are verified together, and lines whose keys are compared with one line's together.
PAIRS, CHUNK = 1 << 16, 1 << 12
#: Times of a column of the matrix, and of a diagonal of one pair, in those of a pair's cells in one column (35 ns).
COLUMN, DIAGONALS = 4800, 100
NO_KEY = np.uint64((1 << 64) - 1)

FOUND = "part long, row long, line int, h1 long, h2 long, chars int"
CLASSES = pa.list_(pa.struct([("line", pa.int32()), ("class_id", pa.int64()), ("links", pa.int64())]))
ROWS = "id long, key long, indexed boolean"
RESULTS = {"n_lines": "long", "n_removed": "long", "n_links": "long",
           "line_classes": "array<struct<line: int, class_id: long, links: long>>"}

_CHARS = words.mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def keys(chars: np.ndarray, offsets: np.ndarray, threshold: int) -> tuple[np.ndarray, ...]:
    """(line, key, indexed) of all bucket entries of lines given as code points.

    A line of n code points has threshold + 1 segments of n // (threshold + 1), the last ones
    one longer. Of a line that is shorter by d it looks up segment i at the places that an alignment with
    at most i edits before and at most threshold - i after it allows. Those substrings that
    are the line's own segments are left out: they are in its bucket already.
    """
    power, back = words.powers(len(chars) + 1), words.inverse_powers(len(chars) + 1)
    sums = np.zeros(len(chars) + 1, np.uint64)
    values = _CHARS[np.minimum(chars, len(_CHARS) - 1)]
    if len(chars) and chars.max() >= len(_CHARS) - 1:
        rare = np.flatnonzero(chars >= len(_CHARS) - 1)
        values[rare] = words.mix(chars[rare].astype(np.uint64) + np.uint64(1))
    np.cumsum(values * power[:-1], out=sums[1:])
    lengths = np.diff(offsets)
    out = []

    def add(own: np.ndarray, at: np.ndarray, size: np.ndarray, other: np.ndarray, i: int, indexed: bool) -> None:
        a = offsets[own] + at
        h = (sums[a + size] - sums[a]) * back[a]
        key = words.mix(words.mix(h) + (other * 64 + i).astype(np.uint64))
        out.append((own, key, np.full(len(own), indexed)))

    for d in range(threshold + 1):
        own = np.flatnonzero(lengths - d > threshold)
        n = lengths[own]
        other = n - d
        short, more = np.divmod(other, threshold + 1)
        for i in range(threshold + 1):
            longer = i - (threshold + 1 - more)  # how many of the segments before are one longer
            size, start = short + (longer >= 0), i * short + np.maximum(longer, 0)
            if d == 0:
                add(own, start, size, other, i, True)
            low = np.maximum(np.maximum(start - i, start + d - (threshold - i)), 0)
            high = np.minimum(np.minimum(start + i, start + d + (threshold - i)), n - size)
            for shift in range(-threshold, threshold + 1):
                at = start + shift
                fits = np.flatnonzero((low <= at) & (at <= high)) if d or shift else ()
                if len(fits):
                    add(own[fits], at[fits], size[fits], other[fits], i, False)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def within(a: list[str], b: list[str], threshold: int) -> np.ndarray:
    """For each pair, whether its edit distance is at most ``threshold`` (up to 31).

    Hyyrö's bit vectors for a diagonal band: one machine word holds the differences between
    neighbouring cells in the rows around the diagonal, and each column of the matrix takes a
    few word operations. Many pairs go through the same columns together; a few pairs of long lines
    are compared one by one by their furthest points, which costs no step per column.
    """
    out = np.zeros(len(a), bool)
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)]).reshape(-1, 2)
    close = np.flatnonzero(np.abs(sizes[:, 0] - sizes[:, 1]) <= threshold)
    order = close[np.argsort(sizes[close].max(axis=1), kind="stable")]
    while len(order):
        # The longest first, as many as give a matrix of bounded size.
        own = order[-max(1, (1 << 21) // (int(sizes[order[-1]].max()) + 2 * threshold + 2)):]
        order = order[: len(order) - len(own)]
        if len(own) * DIAGONALS * (threshold + 1) ** 2 < int(sizes[own[-1]].max()) * (COLUMN + len(own)):
            out[own] = [_seen_from(a[i], b[i], threshold, threshold)[2] <= threshold for i in own]
        else:
            out[own] = _distances([a[i] for i in own], [b[i] for i in own], threshold) <= threshold
    return out


def _matrix(lines: list[str], lead: int, width: int, fill: int) -> np.ndarray:
    out = np.full((len(lines), width), fill, np.uint32)
    for i, x in enumerate(lines):
        out[i, lead : lead + len(x)] = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out.T.copy()


def _distances(a: list[str], b: list[str], t: int) -> np.ndarray:
    m, n = (np.array(list(map(len, x))) for x in (a, b))
    columns = int(n.max())
    pattern = _matrix(a, t, columns + 2 * t + 2 + int(max(0, (m - n).max())), 0xFFFFFFFF)
    text = _matrix(b, 0, columns, 0xFFFFFFFE)
    one, full = np.uint64(1), np.uint64((1 << 2 * t + 1) - 1)
    up = np.full(len(a), np.uint64(((1 << t + 1) - 1) << t))
    down = np.zeros(len(a), np.uint64)
    score = np.full(len(a), t)
    for j in range(columns):
        match = np.zeros(len(a), np.uint64)
        for k in range(2 * t + 1):
            match |= (pattern[j + k] == text[j]).astype(np.uint64) << np.uint64(k)
        zero = ((((match & up) + up) ^ up) | match | down) & full
        plus, minus = (down | ~(zero | up)) & full, zero & up
        diagonal = j + 1 <= m - t
        # Along the lowest diagonal until the last row is reached, then along that row.
        bit = np.clip(m - j - 1 + t, 0, 2 * t).astype(np.uint64)
        step = np.where(diagonal, 1 - (zero >> np.uint64(2 * t) & one).astype(np.int64),
                        (plus >> bit & one).astype(np.int64) - (minus >> bit & one).astype(np.int64))
        score = np.where(j < n, score + step, score)
        up = (minus | ~(zero >> one | plus)) & full
        down = zero >> one & plus
    # A last row above the first band never meets the lowest diagonal.
    return np.where(m < t, _small(a, b, m < t), score)


def _small(a: list[str], b: list[str], which: np.ndarray) -> np.ndarray:
    """Distances of pairs whose first line is shorter than the threshold."""
    out = np.zeros(len(a), np.int64)
    for i in np.flatnonzero(which):
        row = list(range(len(b[i]) + 1))
        for c in a[i]:
            last, row = row, [row[0] + 1]
            for j, d in enumerate(b[i]):
                row.append(min(last[j + 1] + 1, row[-1] + 1, last[j] + (c != d)))
        out[i] = row[-1]
    return out


def dedup_lines(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Every document without its repeated lines, and ``n_lines``, ``n_removed``, ``n_links``.

    Lines are separated by line feeds; those of white space alone are left as they are and not
    counted. Equal lines are one class, and so are lines of at least ``min_chars`` code points
    connected by edit distances of at most ``threshold``. Of each class the first line stays,
    by identifier, then row, then place; every other one goes, with its line feed. ``n_links`` counts
    all links between the document's different lines and other different lines, each end for itself.
    ``line_classes`` has (line, class_id, links) of every line, numbered from 0, that is repeated or linked, in
    their order: ``class_id`` is a hash of the class's first line. Other lines are classes of their own. Null texts stay null
    and have no lines; repeated rows are documents of their own, so the first keeps the
    lines. Input columns named like a result are replaced, all others kept.
    """
    if min_chars <= threshold:
        raise ValueError("lines must have more code points than edits are allowed")
    ship_package(docs.sparkSession)
    plain = docs.select(*tables.without(docs, *RESULTS))
    given = plain.columns
    names = [f"c{i}" for i in range(len(given))]  # so that no input column meets one of this job's own
    id_col, text_col = (names[given.index(c)] for c in (id_col, text_col))
    plain = plain.toDF(*names)
    texts, buckets = tables.numbered(plain, "texts")
    own = texts.select("part", "row", F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    found = tables.stored(tables.mapped(own, _lines, f"{FOUND}, _doc {dict(own.dtypes)['_doc']}"), "lines")
    place = F.struct(F.col("_doc").isNull().alias("none"), "_doc", "row", "line", "part")
    distinct = found.groupBy("h1", "h2", "chars").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("times"))
    distinct = tables.stored(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct-lines")
    long = distinct.where(F.col("chars") >= min_chars).select("id", "at.part", "at.row", "at.line")
    entries = tables.stored(_with_lines(texts, text_col, long, buckets, _entries(threshold), ROWS), "line-keys")
    links = _links(entries, lambda wanted: _line_texts(texts, text_col, long.join(wanted, "id"), buckets), threshold)
    classes = components.connected(links.select(F.col("id").alias("a"), F.col("least").alias("b")))
    degree = links.groupBy("id").agg(F.sum("links").alias("links"))
    classed = distinct.join(classes.withColumnRenamed("node", "id"), "id", "left").join(degree, "id", "left")
    firsts = classed.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("at", "h1")).alias("first"))
    marked = (classed.join(firsts, "component", "left").where("times > 1 OR links > 0")
              .select("h1", "h2", "chars", F.coalesce("first.at", "at").alias("first"), F.coalesce("first.h1", "h1").alias("class_id"),
                      F.coalesce("links", F.lit(0)).alias("links")))
    marks = found.join(marked, ["h1", "h2", "chars"]).select(
        "part", "row", "line", (~((F.col("row") == F.col("first.row")) & (F.col("line") == F.col("first.line")))).alias("gone"),
        "links", "class_id", "h1", "h2")

    def kept(texts: pa.Table, marks: pa.Table) -> pa.Table:
        return _kept(texts, marks, names, text_col)

    schema = plain.withColumns({c: F.lit(None).cast(kind) for c, kind in RESULTS.items()}).withColumn(text_col, F.col(text_col).cast("string")).schema
    kept_docs = texts.groupBy("part").cogroup(marks.repartition(buckets, "part").groupBy("part")).applyInArrow(kept, schema)
    return kept_docs.toDF(*given, *RESULTS)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and hashes of each line with something in it."""
    for batch in batches:
        for cut in tables.slices(batch, "text"):
            data, offsets = tables.raw(tables.column(cut, "text"))
            doc, starts, ends = _bounds(data, offsets)
            h = _hashes(data, starts, ends)
            blank = np.concatenate(([0], np.cumsum(np.isin(data, np.frombuffer(b" \t\r\x0b\x0c\n", np.uint8)))))
            chars = np.concatenate(([0], np.cumsum(data & 0xC0 != 0x80)))
            keep = (blank[ends] - blank[starts]) < ends - starts
            number = np.arange(len(doc)) - np.searchsorted(doc, doc)
            doc, starts, ends = doc[keep], starts[keep], ends[keep]
            yield pa.RecordBatch.from_arrays(
                [tables.column(cut, "part").take(pa.array(doc)), tables.column(cut, "row").take(pa.array(doc)),
                 pa.array(number[keep].astype(np.int32)), *(pa.array(x[keep].view(np.int64)) for x in h),
                 pa.array((chars[ends] - chars[starts]).astype(np.int32)), tables.column(cut, "_doc").take(pa.array(doc))],
                ["part", "row", "line", "h1", "h2", "chars", "_doc"])


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, start and end of every line; a text without line feeds is one line."""
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], feeds + 1)), kind="stable")
    ends = np.sort(np.concatenate((feeds, offsets[1:])), kind="stable")
    # A line that starts where a document ends is the last, empty one of that document.
    doc = np.searchsorted(offsets[1:], ends, side="left")
    return doc, starts, ends


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    power, back = words.powers(len(data) + 1), words.inverse_powers(len(data) + 1)
    out = []
    for k in (1, 2):
        sums = np.zeros(len(data) + 1, np.uint64)
        values = words.mix(np.arange(256, dtype=np.uint64) + np.uint64(1000 * k))
        np.cumsum(values[data] * power[:-1], out=sums[1:])
        out.append(words.mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)))
    return out


def _with_lines(texts: DataFrame, text_col: str, wanted: DataFrame, buckets: int, fn, schema: str) -> DataFrame:
    """fn(ids, lines) over the texts of wanted lines (id, part, row, line), part by part."""
    def apply(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        order = {r: i for i, r in enumerate(tables.column_of(docs, "row").to_pylist())}
        text = tables.column_of(docs, "text")
        cut: dict[int, list[str]] = {}
        ids, lines = tables.column_of(wanted, "id").to_pylist(), []
        for row, line in zip(*(tables.column_of(wanted, c).to_pylist() for c in ("row", "line")), strict=True):
            if row not in cut:
                cut[row] = text[order[row]].as_py().split("\n")
            lines.append(cut[row][line])
        return fn(ids, lines)

    return (texts.select("part", "row", F.col(text_col).alias("text")).groupBy("part")
            .cogroup(wanted.repartition(buckets, "part").groupBy("part")).applyInArrow(apply, schema))


def _points(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    joined = "".join(lines).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), np.concatenate(([0], np.cumsum([len(x) for x in lines], dtype=np.int64)))


def _entries(threshold: int):
    def entries(ids: list[int], lines: list[str]) -> pa.Table:
        chars, offsets = _points(lines)
        own, key, indexed = keys(chars, offsets, threshold)
        return pa.table({"id": pa.array(np.array(ids, np.int64)[own]), "key": pa.array(key.view(np.int64)), "indexed": pa.array(indexed)})

    return entries


def _line_texts(texts: DataFrame, text_col: str, wanted: DataFrame, buckets: int) -> DataFrame:
    def taken(ids: list[int], lines: list[str]) -> pa.Table:
        return pa.table({"id": pa.array(ids, pa.int64()), "line": pa.array(lines, pa.string())})

    return tables.stored(_with_lines(texts, text_col, wanted, buckets, taken, "id long, line string"), "line-texts")


def _links(entries: DataFrame, texts_of, threshold: int) -> DataFrame:
    """(id, least, links) of lines within the threshold of others, in several rows each: a line that is
    linked to it, directly or through others, and a number of its links. They add up to all of its links.
    """
    met = _met(entries)
    texts = texts_of(met.select("id").distinct())
    rounds = [met.where(F.col("lines") <= PAIRED).select(F.col("key").alias("g"), F.col("key").alias("root"), "id", F.lit(0).alias("side"))]
    large = met.where(F.col("lines") > PAIRED).select("key", F.col("key").alias("root"), "id", F.col("lines").alias("n"))
    rounds.append(_divided(large.where(F.col("n") <= HERE), texts, threshold))
    large = large.where(F.col("n") > HERE)
    while not large.isEmpty():
        # Stored in each round, so that no plan grows with their number; merged, so that the driver builds no relations for them.
        seen = tables.stored(_measured(large, texts, threshold), "measured-lines")
        outer = seen.where("NOT inner")
        counts = outer.groupBy("key", "first").agg(F.count(F.lit(1)).alias("n")).hint("merge")
        points = tables.stored(
            outer.join(counts, ["key", "first"]).select("key", "root", F.col("first").alias("at"), "id", "n"), "line-places")
        places = points.select("key", "at").distinct().hint("merge")
        spans = (outer.where("first < reach")
                 .select("key", "root", "id", F.explode(F.sequence(F.col("first") + 1, "reach")).alias("at"))
                 .join(places, ["key", "at"], "left_semi"))
        rounds.append(tables.stored(
            _grouped(seen.where("inner"), "inner", 0).unionByName(
                _grouped(seen.where("inner"), "shell", 1)).unionByName(_grouped(seen.where("shell"), "shell", 2)).unionByName(
                _grouped(points.where(F.col("n") <= PAIRED), "place", 0, "at")).unionByName(
                _grouped(points, "near", 1, "at")).unionByName(_grouped(spans, "near", 2, "at")), "line-groups"))
        large = points.where(F.col("n") > PAIRED).select(F.xxhash64("key", "at").alias("key"), "root", "id", "n")
        rounds.append(tables.stored(_divided(large.where(F.col("n") <= HERE), texts, threshold), "line-groups"))
        large = large.where(F.col("n") > HERE)
    groups = functools.reduce(DataFrame.unionByName, rounds)
    return tables.stored(_compared(tables.stored(groups, "line-groups"), texts, threshold), "line-links")


def _grouped(members: DataFrame, kind: str, side: int, *more: str) -> DataFrame:
    return members.select(F.xxhash64("key", F.lit(kind), *more).alias("g"), "root", "id", F.lit(side).alias("side"))


def _divided(buckets: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The groups (g, root, id, side) of buckets (key, root, id) of at most HERE lines.

    The same groups as rounds of ``_measured`` lead to, without those in which nothing is compared.
    """
    paired = PAIRED

    def divided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "key"):
            keys_of, roots, ids = (tables.column_of(table, c).to_pylist() for c in ("key", "root", "id"))
            lines = tables.column_of(table, "line").to_pylist()
            edges = [i for i, k in enumerate(keys_of) if not i or k != keys_of[i - 1]] + [len(ids)]
            out = ([], [], [], [])
            for first, end in zip(edges, edges[1:], strict=False):
                for g, side, members in _groups_of(keys_of[first], lines[first:end], threshold, paired):
                    for x, values in zip(out, ([g] * len(members), [roots[first]] * len(members),
                                               [ids[first + i] for i in members], [side] * len(members)), strict=True):
                        x.extend(values)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.int32())], ["g", "root", "id", "side"])

    rows = buckets.select("key", "root", "id").join(texts, "id").repartition(_parts(texts), "key").sortWithinPartitions("key", "id")
    return tables.mapped(rows, divided, "g long, root long, id long, side int")


def _groups_of(key: int, lines: list[str], threshold: int, paired: int) -> Iterator[tuple[int, int, list[int]]]:
    """(g, side, numbers of lines) of all groups that a bucket is divided into."""
    def named(key: int, kind: bytes, at: int = 0) -> int:
        return int.from_bytes(hashlib.blake2b(struct.pack("<qq", key, at) + kind, digest_size=8).digest(), "little", signed=True)

    waiting = [(key, np.arange(len(lines)))]
    while waiting:
        key, own = waiting.pop()
        seen = np.array([_seen_from(lines[own[0]], lines[i], threshold) for i in own], np.int64)
        first, reach, distance = seen.T
        inner, shell = own[distance <= threshold], own[(distance > threshold) & (distance <= 2 * threshold)]
        if len(inner) > 1:
            yield named(key, b"inner"), 0, inner.tolist()
        if len(shell):
            yield named(key, b"shell"), 1, inner.tolist()
            yield named(key, b"shell"), 2, shell.tolist()
        outer = distance > threshold
        for at in np.unique(first[outer]).tolist():
            points = own[outer & (first == at)]
            spans = own[outer & (first < at) & (reach >= at)]
            if len(points) > paired:
                waiting.append((named(key, b"bucket", at), points))
            elif len(points) > 1:
                yield named(key, b"place", at), 0, points.tolist()
            if len(spans):
                yield named(key, b"near", at), 1, points.tolist()
                yield named(key, b"near", at), 2, spans.tolist()


def _whole(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """Tables that hold all rows of each value of a column by which the rows are ordered."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        at = np.asarray(tables.column_of(table, by))
        done = int(np.searchsorted(at, at[-1])) if len(at) else 0
        rest = table.slice(done)
        if done:
            yield table.slice(0, done)
    if rest is not None:
        yield rest


def _parts(df: DataFrame) -> int:
    return max(12, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _measured(buckets: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Each line of the buckets (key, root, id) as seen from the bucket's least line.

    ``first``: length of the common beginning; ``inner``: within the threshold; ``shell``: beyond it,
    but within twice the threshold; ``reach``: how much of the least line some beginning of this
    one is within the threshold of. Of two lines that aren't inner the one with the shorter common
    beginning is within the threshold of the other only if the other's ends within its reach:
    up to there the other one equals the least line. An inner line is within the threshold of
    others only if they are inner too or in the shell.
    """
    heads = buckets.groupBy("key").agg(F.min("id").alias("head"))
    sides = (buckets.join(heads.hint("merge"), "key").join(texts.hint("merge"), "id")
             .join(texts.select(F.col("id").alias("head"), F.col("line").alias("one")).hint("merge"), "head"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_seen_from(a, b, threshold) for a, b in zip(
                tables.column(batch, "one").to_pylist(), tables.column(batch, "line").to_pylist(), strict=True)]
            first, reach, distance = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
            yield pa.RecordBatch.from_arrays(
                [*(tables.column(batch, c) for c in given), pa.array(first), pa.array(reach),
                 pa.array(distance <= threshold), pa.array((distance > threshold) & (distance <= 2 * threshold))],
                [*given, "first", "reach", "inner", "shell"])

    given = ("key", "root", "id")
    return tables.mapped(sides.select(*given, "one", "line"), measured,
                         "{} long, first long, reach long, inner boolean, shell boolean".format(" long, ".join(given)))


def _seen_from(a: str, b: str, threshold: int, most: int | None = None) -> tuple[int, int, int]:
    """Common beginning of a and b, reach of b along a, and their distance up to ``most`` + 1, by default 2 * threshold + 1.

    Furthest points per diagonal for 0, 1, ... edits.
    """
    most = 2 * threshold if most is None else most
    first = _equal(a, 0, b, 0)
    far, reach, target = {0: first}, first, len(a) - len(b)
    for edits in range(most + 1):
        if edits:
            new = {}
            for d in range(-edits, edits + 1):
                at = max(far.get(d, -9) + 1, far.get(d - 1, -9) + 1, far.get(d + 1, -9))
                at = min(at, len(a), len(b) + d)
                if at >= max(0, d):
                    new[d] = at + _equal(a, at, b, at - d)
            far = new
            if edits <= threshold:
                reach = max(reach, *far.values())
        if far.get(target) == len(a):
            return first, reach, edits
    return first, reach, most + 1


def _equal(a: str, i: int, b: str, j: int) -> int:
    """How many code points from a[i] and b[j] on are equal."""
    start, step = i, 64
    while step:
        if i + step <= len(a) and a[i : i + step] == b[j : j + step]:
            i, j = i + step, j + step
        else:
            step //= 2
    return i - start


def _met(entries: DataFrame) -> DataFrame:
    """(key, id, lines) of buckets with an indexed line and another one."""
    many = entries.groupBy("key").agg(F.count(F.lit(1)).alias("lines"), F.bool_or("indexed").alias("any"))
    met = entries.join(many.where("lines > 1 AND any").select("key"), "key").select("key", "id").distinct()
    met = tables.stored(met, "line-buckets")
    held = met.groupBy("key").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1")
    return met.join(held, "key")


def _compared(groups: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Links in groups (g, root, id, side): between all lines of side 0, and between those of sides 1 and 2.

    Each side is dealt to blocks of about GROUP lines, and each pair of blocks is one task's
    work (g, i, j), so that a line goes to a task once and not once for each partner. Two lines may share several
    buckets; they are compared in that of their least key (``root``) only.
    """
    n = [F.ceil(F.sum((F.col("side") == k).cast("long")) / GROUP).alias(f"n{k}") for k in range(3)]
    own = F.count(F.when(F.col("side") == 0, 1))
    both = F.least(*(F.count(F.when(F.col("side") == k, 1)) for k in (1, 2)))
    sizes = groups.groupBy("g").agg(*n, own.alias("own"), both.alias("both")).where("own > 1 OR both > 0")
    sized = groups.join(sizes, "g").where("CASE WHEN side = 0 THEN own > 1 ELSE both > 0 END").withColumn(
        "block", F.expr("pmod(xxhash64(id), CASE side WHEN 0 THEN n0 WHEN 1 THEN n1 ELSE n2 END)"))
    dealt = sized.withColumn("other", F.explode(F.expr("sequence(0L, CASE side WHEN 0 THEN n0 WHEN 1 THEN n2 ELSE n1 END - 1)")))
    dealt = dealt.select(
        "g", "root", "id", (F.col("side") == 0).alias("own"),
        F.expr("CASE side WHEN 0 THEN least(block, other) WHEN 1 THEN block ELSE other END").alias("i"),
        F.expr("CASE side WHEN 0 THEN greatest(block, other) WHEN 1 THEN other ELSE block END").alias("j"),
        F.expr("CASE WHEN side = 0 THEN int(block > other) ELSE side - 1 END").alias("part"))
    task = F.xxhash64("g", "own", "i", "j")
    rows = dealt.select(task.alias("task"), "root", (F.col("own") & (F.col("i") == F.col("j"))).alias("whole"), "part", "id").join(texts, "id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "task"):
            yield from _pair_links(table, threshold)

    return tables.mapped(rows.repartition(_parts(texts), "task").sortWithinPartitions("task"), compared, "id long, least long, links long")


def _pair_links(group: pa.Table, threshold: int) -> Iterator[pa.RecordBatch]:
    """Links of the lines of whole tasks, ordered by task."""
    task, root, part, ids = (np.asarray(tables.column_of(group, c)) for c in ("task", "root", "part", "id"))
    whole = np.asarray(tables.column_of(group, "whole").to_pylist(), bool)
    lines = tables.column_of(group, "line").to_pylist()
    if not lines:
        return
    key, indexed = _key_rows(lines, threshold)
    root = root.view(np.uint64)
    least, links = np.arange(len(lines)), np.zeros(len(lines), np.int64)
    waiting, count = [], 0

    def settle() -> None:
        nonlocal waiting, count
        a, b = (np.concatenate(x) for x in zip(*waiting, strict=True))
        waiting, count = [], 0
        ok = within([lines[i] for i in a], [lines[i] for i in b], threshold)
        a, b = a[ok], b[ok]
        np.add.at(links, a, 1)
        np.add.at(links, b, 1)
        while (least[a] != least[b]).any():
            low = np.minimum(least[a], least[b])
            np.minimum.at(least, least[a], low)
            np.minimum.at(least, least[b], low)
            np.minimum.at(least, a, low)
            np.minimum.at(least, b, low)

    edges = np.flatnonzero(np.concatenate(([True], task[1:] != task[:-1], [True])))
    for first, end in zip(edges, edges[1:], strict=False):
        own = np.arange(first, end)
        left = own if whole[first] else own[part[own] == 0]
        right = own if whole[first] else own[part[own] == 1]
        for a in left:
            b = right[right > a] if whole[first] else right
            b = b[(root[b] == root[a]) & (ids[b] != ids[a])]
            # The least key that both have and under which one of them is indexed.
            for cut in range(0, len(b), CHUNK):
                c = b[cut : cut + CHUNK]
                shared = (key[c][:, :, None] == key[a]) & (indexed[c][:, :, None] | indexed[a])
                c = c[np.where(shared.any(axis=2), key[c], NO_KEY).min(axis=1) == root[a]]
                if len(c):
                    waiting.append((np.full(len(c), a), c))
                    count += len(c)
            if count >= PAIRS:
                settle()
    if count:
        settle()
    at = np.flatnonzero(links)
    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[least[at]]), pa.array(links[at])], ["id", "least", "links"])


def _key_rows(lines: list[str], threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of keys for each line, filled up with NO_KEY, never indexed, and which of them are indexed."""
    own, key, indexed = keys(*_points(lines), threshold)
    order = np.argsort(own, kind="stable")
    own, key, indexed = own[order], key[order], indexed[order]
    counts = np.bincount(own, minlength=len(lines))
    at = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
    keys_of = np.full((len(lines), max(1, int(counts.max()))), NO_KEY)
    flags = np.zeros(keys_of.shape, bool)
    keys_of[own, at], flags[own, at] = key, indexed
    return keys_of, flags


def _kept(texts: pa.Table, marks: pa.Table, names: list[str], text_col: str) -> pa.Table:
    gone: dict[int, set[int]] = {}
    links: dict[int, dict[tuple[int, int], int]] = {}
    classes: dict[int, list[dict]] = {}
    held = ("row", "line", "gone", "links", "class_id", "h1", "h2")
    for row, line, out, n, own_class, *h in zip(*(tables.column_of(marks, c).to_pylist() for c in held), strict=True):
        if out:
            gone.setdefault(row, set()).add(line)
        links.setdefault(row, {})[tuple(h)] = n
        classes.setdefault(row, []).append({"line": line, "class_id": own_class, "links": n})
    own, n_lines, n_removed = [], [], []
    rows = tables.column_of(texts, "row").to_pylist()
    for row, text in zip(rows, tables.column_of(texts, text_col).to_pylist(), strict=True):
        lines = (text or "").split("\n")
        out = gone.get(row, ())
        n_lines.append(sum(1 for x in lines if x.strip(" \t\r\x0b\x0c")))
        n_removed.append(len(out))
        own.append(text if not out else "\n".join(x for i, x in enumerate(lines) if i not in out))
    columns = {c: tables.column_of(texts, c) for c in names} | {text_col: pa.array(own, pa.string())}
    return pa.table(columns | {"n_lines": pa.array(n_lines, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                               "n_links": pa.array([sum(links.get(r, {}).values()) for r in rows], pa.int64()),
                               "line_classes": pa.array([sorted(classes.get(r, []), key=lambda x: x["line"]) for r in rows], CLASSES)})
