"""Nulls, empty tables, very long texts, repeated rows and clashing columns in every operator and stage."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from addrwatch.llm import decontamination, labelled, lines, near, packing, quality, repeats, secrets, token_files, toxicity
from addrwatch.session import scratch_dir

LONG = " ".join(f"word{k * k % 9973}" for k in range(60_000))
CLASHES = ("row", "part", "line", "key", "node", "score", "spans", "kept", "length", "piece", "N_Words", "n_hit", "id", "label", "lang",
           "n_lines", "toxic_terms", "item_ids", "class_id", "sequence_id", "offset", "start", "ids", "contaminated", "_marked", "text_key")
ROWS = [(1, "one text"), (1, "one text"), (None, "one text"), (2, None), (None, None), (3, ""), (4, " \n\t"), (5, LONG), (6, LONG), (7, "é")]


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(spark, request):
    df = spark.createDataFrame(ROWS if request.param == "rows" else [], "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def model_of(spark, docs):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(8)], "doc_id long, quality int, toxic int")
    return labels, F.lit(True)


def files(spark, docs):
    folder = scratch_dir(spark, "odd")
    token_files.write(token_files.token_table(docs, public_tokenizers.path("byte_bpe_50k.json"), 2), folder)
    return token_files.read(spark, folder)


OPERATORS = {
    "packing": lambda s, d: packing.pack(packing.token_pieces(d, public_tokenizers.path("word_bpe_49k.json"))).where("piece = 0"),
    "files": files,
    "decontamination": lambda s, d: decontamination.contamination(d, s.createDataFrame([("a", "one text"), (None, None)], "item_id string, text string")),
    "lines": lambda s, d: lines.dedup_lines(d),
    "repeats": lambda s, d: repeats.repeats(d),
    "secrets": lambda s, d: secrets.scan(d),
    "toxicity": lambda s, d: toxicity.scored(d, toxicity.fit(d, *model_of(s, d))),
    "quality": lambda s, d: quality.scored(d, quality.fit(d, *model_of(s, d))),
    "near": lambda s, d: near.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, docs, name):
    assert OPERATORS[name](spark, docs).toPandas().shape[0] == docs.count()


def test_stages_take_odd_tables(spark, docs, tmp_path):
    spark.createDataFrame([(k, 1, 0) for k in range(8)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"),
                        *[c for c in CLASHES if c != "lang"])
    for name, stage in corpus_pipeline.STAGES:
        plain.write.parquet(f"{tmp_path}/{name}")
        before = spark.read.parquet(f"{tmp_path}/{name}")
        plain = stage(spark, before, str(tmp_path))
        if name != "packing":
            assert plain.columns == before.columns, name
    rows = plain.collect()
    assert (len(rows) > 0) == (docs.count() > 0)


def test_one_document_of_a_class_stays(spark, tmp_path):
    rows = [(3, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "a b c d e f g h"), (None, "a b c d e f g h"), (5, "other words"), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.one_of_a_class(spark, df, "").collect()) == [1, 5, 6]


def test_labels_are_told_apart_by_the_crc_of_the_identifier(spark):
    import zlib
    got = spark.range(50).select("id", labelled.remainder("id", 5).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)
