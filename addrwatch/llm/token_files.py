"""Token ids in binary files, as frequency ranks in byte-aligned variable-length code.

A folder holds ``shard-*.ids`` files in ascending document order, a table ``ranks`` (rank,
id, count) and a table ``shards`` with each file's totals. A rank takes one to four bytes,
least first; how many is kept apart, two bits a rank, four ranks to a control byte. So
frequent ids take one byte, and a file is decoded by one table look-up per control byte.

File: 8 bytes of magic, then as little-endian 64-bit numbers how many documents, control bytes
and data bytes follow; identifiers (int64), a byte per document that is 1 where the identifier
is null, ids per document (uint32), control bytes, data bytes. Each document starts a control
byte of its own; its last one is filled up with rank 0.
"""

from __future__ import annotations

import struct
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from addrwatch.llm import tables, tokens
from addrwatch.operators import prefix

MAGIC = b"IDRANK01"
HEADER = "<8s3Q"
HEADER_BYTES = struct.calcsize(HEADER)
SHARD_TOKENS = 8_000_000
#: Ranges whose tokens are counted per file.
RANGES = 16
#: Bytes of each of the four ranks of a control byte.
WIDTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)

TOKENS = "row long, doc_id long, n_tokens long, ids binary"
SHARDS = "shard int, n_docs long, n_tokens long, n_bytes long"
READ = "shard int, nth long, doc_id long, start_in_shard long, n_tokens long, ids binary"


def _padded(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots before each document when each starts anew at a multiple of four; index of each value's slot."""
    slots = np.concatenate(([0], np.cumsum(-(-counts // 4) * 4)))
    starts = np.cumsum(counts) - counts
    return slots, np.repeat(slots[:-1] - starts, counts) + np.arange(counts.sum())


def encode(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of documents with so many ranks each, and where each document's begin."""
    slots, at = _padded(counts)
    values = np.zeros(slots[-1], dtype="<u4")
    values[at] = ranks
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    control = (extra.reshape(-1, 4) * np.array([1, 4, 16, 64], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    ends = np.concatenate(([0], np.cumsum(extra.astype(np.int64) + 1)))
    return control, data, slots // 4, ends[slots]


def decode(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranks again, without the fill."""
    values = np.zeros((len(control) * 4, 4), np.uint8)
    values[np.arange(4) < WIDTHS[control].reshape(-1, 1)] = data
    return values.view("<u4").ravel()[_padded(counts)[1]]


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Ids of each whole text and the end id, in a stored table; null texts give the end id alone."""
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokens.tokenizer(tokenizer_path).ids
        end = np.array([end_id], dtype="<u4").tobytes()
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in tables.slices(batch, "text"):
                ids = [ids_of(text) + end for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + len(ids)), pa.int64()), part.column(0),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["row", "doc_id", "n_tokens", "ids"])
                row += len(ids)

    return tables.stored(tables.mapped(tables.ids_of(docs, id_col, text_col), encoded, TOKENS), "ids")


def frequency(table: DataFrame) -> DataFrame:
    """(rank, id, count) of every id that occurs: most frequent first, then by id."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for part in tables.slices(batch, "ids"):
                own = np.bincount(tables.raw(tables.column(part, "ids"))[0].view("<u4"), minlength=len(seen))
                own[: len(seen)] += seen
                seen = own
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seen[ids], pa.int64())], ["id", "count"])

    counts = tables.mapped(table.select("ids"), counted, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))
    # As many rows as the vocabulary has entries at most.
    return counts.select((F.row_number().over(Window.orderBy(F.desc("count"), "id")) - 1).alias("rank"), "id", "count")


def write(table: DataFrame, folder: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes the file format. table: a stored table as of ``token_table``.

    Rows are dealt to files by ranges of (doc_id, row) with about equal numbers of tokens, null identifiers first; the
    ranges are found before the ids are coded, from the narrow columns alone. A file is put
    in place under its own name when it is whole, so a task that runs again replaces it.
    """
    spark = table.sparkSession
    frequency(table).coalesce(1).write.parquet(f"{folder}/ranks")
    ranks = spark.read.parquet(f"{folder}/ranks").select("id", "rank").toPandas()  # bounded by the vocabulary
    rank_of = np.zeros(int(ranks["id"].max()) + 1 if len(ranks) else 1, dtype="<u4")
    rank_of[ranks["id"].to_numpy()] = ranks["rank"].to_numpy()
    shared = spark.sparkContext.broadcast(rank_of)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tables.slices(batch, "ids"):
                data, _ = tables.raw(tables.column(part, "ids"))
                counts = np.asarray(tables.column(part, "n_tokens"))
                control, coded, control_at, coded_at = encode(shared.value[data.view("<u4")], counts)
                yield pa.RecordBatch.from_arrays(
                    [tables.column(part, "row"), tables.column(part, "doc_id"), tables.column(part, "n_tokens"),
                     tables.column(part, "shard"), tables.binaries(control, control_at), tables.binaries(coded, coded_at)],
                    ["row", "doc_id", "n_tokens", "shard", "control", "data"])

    def saved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, nulls, counts, control, data = [], [], [], [], []
        for batch in batches:
            ids = tables.column(batch, "doc_id")
            docs.append(np.asarray(ids.fill_null(0)))
            nulls.append(np.asarray(ids.is_null()).astype(np.uint8))
            counts.append(np.asarray(tables.column(batch, "n_tokens")).astype("<u4"))
            control.append(tables.raw(tables.column(batch, "control"))[0])
            data.append(tables.raw(tables.column(batch, "data"))[0])
        n = sum(map(len, docs))
        if not n:
            return
        shard = TaskContext.get().partitionId()
        store, path = fs.FileSystem.from_uri(folder)
        own = f"{path}/.shard-{shard}-{uuid.uuid4().hex}"
        sizes = [sum(map(len, x)) for x in (control, data)]
        with store.open_output_stream(own) as out:
            out.write(struct.pack(HEADER, MAGIC, n, *sizes))
            for values in (docs, nulls, counts, control, data):
                for x in values:
                    out.write(np.ascontiguousarray(x))
            total = out.tell()
        store.move(own, f"{path}/shard-{shard:07d}.ids")
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "n_docs": [n], "n_tokens": [int(sum(int(c.sum()) for c in counts))], "n_bytes": [total]},
            schema=pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))

    placed, files = _placed(table, shard_tokens)
    codes = tables.mapped(placed, coded, "row long, doc_id long, n_tokens long, shard int, control binary, data binary")
    ordered = codes.repartitionById(files, "shard").sortWithinPartitions("doc_id", "row")
    tables.mapped(ordered, saved, SHARDS).write.parquet(f"{folder}/shards")


def _placed(table: DataFrame, shard_tokens: int) -> tuple[DataFrame, int]:
    """The table with the number of each row's file, and how many files there are.

    Ranges of (doc_id, row), a few per file, are summed up; consecutive ones go to a file until it is full. A hot doc_id is
    cut by row.
    """
    rows, total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    files = max(1, -(-total // shard_tokens))
    if files == 1:
        return table.withColumn("shard", F.lit(0)), 1
    order = F.coalesce(F.col("doc_id").cast("double"), F.lit(-sys.float_info.max))
    cut = prefix.ranged(table, order, F.col("row"), False, max(1, rows // (RANGES * files))).drop("_order", "_tie")
    sums = cut.groupBy("_range", "_part").agg(F.sum("n_tokens").alias("n")).orderBy("_range", "_part").collect()  # a few per file
    begins = np.cumsum([0, *(r["n"] for r in sums)])[:-1]
    shards = [(r["_range"], r["_part"], int(b // shard_tokens)) for r, b in zip(sums, begins, strict=True)]
    numbers = table.sparkSession.createDataFrame(shards, "_range int, _part int, shard int")
    # A few rows per file, three integers each: the ids aren't moved for this join.
    return cut.join(F.broadcast(numbers), ["_range", "_part"]).drop("_range", "_part"), shards[-1][2] + 1


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a folder: its file, number within it, start there and overall, and ids.

    Columns: shard, nth, doc_id, start_in_shard, n_tokens, ids (little-endian uint32), start.
    """
    ranks = spark.read.parquet(f"{folder}/ranks").toPandas()  # bounded by the vocabulary
    id_of = np.zeros(len(ranks), dtype="<u4")
    id_of[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()
    shared = spark.sparkContext.broadcast(id_of)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = int(path.rpartition("-")[2].partition(".")[0])
                for part in _documents(np.frombuffer(content.as_buffer(), np.uint8), shared.value):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), shard, np.int32)), *part],
                                                     ["shard", "nth", "doc_id", "start_in_shard", "n_tokens", "ids"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.ids").load(folder)
             .select("path", "content"))
    # One row per file; their running total is all that one task sees.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = spark.read.schema(SHARDS).parquet(f"{folder}/shards").select(
        "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("_base"))
    return (tables.mapped(files, decoded, READ).join(bases, "shard")
            .withColumn("start", F.col("_base") + F.col("start_in_shard")).drop("_base"))


def _documents(content: np.ndarray, id_of: np.ndarray, run_tokens: int = 1 << 20) -> Iterator[list[pa.Array]]:
    """Runs of the documents of one file."""
    magic, n, n_control, n_data = struct.unpack(HEADER, content[:HEADER_BYTES].tobytes())
    if magic != MAGIC or len(content) != HEADER_BYTES + 13 * n + n_control + n_data:
        raise ValueError("not a whole file of this format")
    docs, nulls, counts, control, data = np.split(
        content[HEADER_BYTES :], np.cumsum([8 * n, n, 4 * n, n_control]))
    docs, counts = docs.copy().view("<i8"), counts.copy().view("<u4").astype(np.int64)
    starts = np.cumsum(counts) - counts
    control_at = np.concatenate(([0], np.cumsum(-(-counts // 4))))
    first, data_at = 0, 0
    while first < n:
        last = max(int(np.searchsorted(starts, starts[first] + run_tokens)), first + 1)
        own = control[control_at[first] : control_at[last]]
        size = int(WIDTHS[own].sum(dtype=np.int64))
        ids = id_of[decode(own, data[data_at : data_at + size], counts[first:last])]
        data_at += size
        ends = np.concatenate(([0], np.cumsum(counts[first:last]))) * 4
        yield [pa.array(np.arange(first, last)), pa.array(docs[first:last], mask=nulls[first:last].astype(bool)),
               pa.array(starts[first:last]), pa.array(counts[first:last]), tables.binaries(ids.view(np.uint8), ends)]
        first = last
