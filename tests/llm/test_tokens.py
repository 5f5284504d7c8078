"""Cut tokenizing equals whole-text tokenizing; the file format gives back what went in."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from addrwatch.llm import token_files, tokens

TEXTS = [
    "", " ", "\n", "don't 'saw' it's they'll we'VE", "word.\n\nNext,word  two   three\t\ttab \n x", "a\x1c \x1fb\x85c d　e",
    "ÀÉÎ straße ŒUVRE İstanbul ΟΔΥΣΣΕΥΣ", "Ź ẹ́ ́x", "12,345.67 v2.0", "<|endoftext|> <|startoftext|>x", "a<|EndOfText|>b <|endoftext|>", "word. <|endoftext|>\n\n<|endoftext|><|startoftext|> x", "🙂🙃 café́",
    "foo.bar(baz)['q'];\r\n\tif (x){y}", "   lead", "trail   ", "a b   c", "x" * 500 + "."]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cut_texts_give_the_same_ids(name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    own = tokens.TextTokenizer(path)
    assert own.letters is not None
    rng = random.Random(3)
    pool = list("abcXYZéß'’.,!? \n\t\r\x1c ́ 019<|>_-#") + ["the", " of", "It's"]
    texts = TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 60))) for _ in range(1500)]
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_part_cache_stays_bounded():
    cache = tokens._Parts(str.encode, limit=3)
    for k in "abcdefga":
        assert cache[k] == k.encode()
        assert len(cache) <= 3 and len(cache.older) <= 3


def test_ranks_are_coded_back(spark):
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 9, 50)
    ranks = rng.choice([0, 5, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], counts.sum()).astype("<u4")
    control, data, control_at, data_at = token_files.encode(ranks, counts)
    assert (token_files.decode(control, data, counts) == ranks).all()
    for i in range(50):
        own = token_files.decode(control[control_at[i] : control_at[i + 1]], data[data_at[i] : data_at[i + 1]], counts[i : i + 1])
        assert (own == ranks[counts[:i].sum() : counts[: i + 1].sum()]).all()


def test_files_hold_all_documents_in_order(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(7, "seven " * 300), (None, "none"), (3, None), (3, ""), (1, "one two"), (1, "one two"), (2, "á" * 50)]
    table = token_files.token_table(spark.createDataFrame(rows, "doc_id long, text string"), path, end_id=2)
    folder = f"file://{tmp_path}/ids"
    token_files.write(table, folder, shard_tokens=20)
    got = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 1, 2, 3, 3, 7]
    assert len({r["shard"] for r in got}) > 1
    tokenizer, start = Tokenizer.from_file(path), 0
    texts = {None: "none", 1: "one two", 2: "á" * 50, 3: "", 7: "seven " * 300}
    for r in got:
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) == (start, len(ids), ids)
        start += len(ids)


def test_a_hot_identifier_is_cut_into_files_by_row(spark, tmp_path):
    rows = [(i, 5 if i % 3 else i, 3) for i in range(600)]
    table = spark.createDataFrame(rows, "row long, doc_id long, n long").select("row", "doc_id", F.col("n").alias("n_tokens"))
    table = table.withColumn("ids", F.unhex(F.repeat(F.lit("07000000"), 3)))
    folder = f"file://{tmp_path}/ids"
    token_files.write(table.repartition(4), folder, shard_tokens=90)
    got = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(d for _, d, _ in rows)
    assert [r["start"] for r in got] == list(range(0, 1800, 3))
    held = [sum(1 for r in got if r["shard"] == s) for s in {r["shard"] for r in got}]
    assert len(held) > 10 and max(held) <= 60


def test_broken_files_are_refused():
    with pytest.raises(ValueError):
        list(token_files._documents(np.zeros(40, np.uint8), np.zeros(1, "<u4")))
