"""Documents to packed sequences: quality, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from addrwatch.llm import decontamination, labelled, lines, near, packing, quality, tables


def keeping_columns(stage):
    """The stage with all columns of its input in its result, whatever they are called."""
    @wraps(stage)
    def kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = [c if c in ("doc_id", "text", "n_chars") else f"_column{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*aside), sf_dir).select(aside).toDF(*docs.columns)

    return kept


@keeping_columns
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of label 1 is 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, labelled.remainder("doc_id", 5) != 0)
    return quality.scored(docs, model).where("score >= 0.3")


@keeping_columns
def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a document that has lost all its lines goes."""
    found = lines.dedup_lines(docs)
    left = found.where("n_removed = 0 OR n_removed < n_lines")
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))


@keeping_columns
def one_of_a_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least identifier of each class of near-duplicates."""
    row = ["doc_id", "text_key", "text_bytes"]
    classes = near.near_duplicates(docs)
    first = classes.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), *row)).alias("x"))
    first = tables.stored(first.select(*(F.col(f"x.{c}").alias(f"_{c}") for c in row)), "near-kept")
    keyed = docs.withColumns({"text_key": F.xxhash64("text"), "text_bytes": F.coalesce(F.octet_length("text"), F.lit(0))})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in row]
    # Repeated rows, equal in all of these, are one class too.
    return keyed.join(first, same, "left_semi").dropDuplicates(row)


@keeping_columns
def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than one in twenty is inside a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(docs, benchmark).where("NOT contaminated")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of a document in a sequence of 4096 tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    items = pieces.select("row", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(items).drop("row")


STAGES = [
    ("quality", good_quality),
    ("line_dedup", first_lines),
    ("near_dedup", one_of_a_class),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: SQL has no tokenizer, compression or sampling of this kind.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents table, each to the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tables.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
