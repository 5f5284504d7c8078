"""Arrow batches in tasks, and tables stored in the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from addrwatch.session import scratch_dir, ship_package

#: Bytes of text that one numpy pass works on, so that a task's memory doesn't follow the batch.
SLICE_BYTES = 4 << 20
#: Documents that are joined with what was found in them at a time: two to this power.
PART_BITS = 10


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read back.

    Later jobs read the written files, so a lost executor repeats neither the work before
    this point nor any choice that depends on the order of rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """The documents with (part, row), stored in buckets by part, and how many buckets.

    A part is at most two to the power PART_BITS consecutive rows. What is dealt to as many
    partitions by part is joined with the documents without moving their texts.
    """
    buckets = max(1, docs.rdd.getNumPartitions())
    row = F.monotonically_increasing_id()
    own = docs.select(*without(docs, "row", "part")).withColumn("row", row).withColumn("part", F.shiftright("row", PART_BITS))
    name = f"{purpose}_{uuid.uuid4().hex}"
    own.write.option("path", scratch_dir(docs.sparkSession, purpose)).option("compression", "zstd").bucketBy(
        buckets, "part").saveAsTable(name, format="parquet")
    return docs.sparkSession.table(name), buckets


def bucketed(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """The rows, stored in as many buckets by a key as a shuffle has partitions, so that joins by that key don't move them."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{purpose}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.option("path", scratch_dir(spark, purpose)).option("compression", "zstd").bucketBy(
        buckets, key).saveAsTable(name, format="parquet")
    return spark.table(name)


def mapped(df: DataFrame, fn, schema) -> DataFrame:
    """mapInArrow with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive cuts of a batch with at most ``limit`` bytes in a column, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
    first = 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, done + limit, side="right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def raw(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row's begin; null is empty."""
    kind = pa.large_binary() if pa.types.is_binary(values.type) or pa.types.is_large_binary(values.type) else pa.large_string()
    values = pc.fill_null(values.cast(kind), b"" if kind == pa.large_binary() else "")
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    if values.buffers()[2] is None or not len(values):
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    data = np.frombuffer(values.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column from all its bytes and where each row's begin."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(data))],
    )


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of a table that don't clash with the given ones; Spark's names ignore case."""
    taken = {n.lower() for n in names}
    return [f"`{c}`" for c in df.columns if c.lower() not in taken]


def ids_of(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Identifier and text only, under fixed names."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def column_of(table: pa.Table, name: str) -> pa.Array:
    """A column of a table as one array."""
    found = table.column(name).combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found
