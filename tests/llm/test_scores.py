"""Learned scores: what they tell apart on rows kept out of the learning."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrwatch.llm import labelled, quality, toxicity

SF = "/root/testdata/sf0.1"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet")


def judged(scores, labels, label, held_out):
    rows = scores.join(labels, "doc_id").where(held_out).select("score", label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


def auc(score, y):
    ranks = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    for s in np.unique(score):
        ranks[score == s] = ranks[score == s].mean()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark)
    model = quality.fit(docs, labels, labelled.remainder("doc_id", 5) != 0)
    score, y = judged(quality.scored(docs, model), labels, "quality", labelled.remainder("doc_id", 5) == 0)
    assert auc(score, y) > 0.97
    assert ((score >= 0.3) == y).mean() > 0.97


def test_toxicity_on_held_out_rows(spark):
    docs, labels = tables(spark)
    lexicon = toxicity.fit(docs, labels, labelled.remainder("doc_id", 4) != 2)
    score, y = judged(toxicity.scored(docs, lexicon), labels, "toxic", labelled.remainder("doc_id", 4) == 2)
    assert auc(score, y) > 0.93
    assert ((score >= 0.3) == y).mean() > 0.97


def test_disguised_words_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "ciown": 3.0}, exceptions=("ciass ciown",))
    words = lambda text: sorted(e for e, _ in lexicon.matches(text)[0])
    for text in ("an IDIOT!", "1d10t", "іdіоt", "ｉｄｉｏｔ", "ídïot", "idiots", "i​diot"):
        assert words(text) == ["idiot"], text
    assert words("the class clown") == []
    assert words("the class clown, clown") == ["ciown"]
    assert words("periodic tables") == [] and words("") == []
    assert lexicon.numbers(["", None, "idiot"])[:, 0].tolist() == [0, 0, np.log1p(5.0)]


@pytest.mark.parametrize("rows", [[], [(1, 1, 1)], [(1, 0, 0), (2, 1, 1)], [(None, 1, 1), (1, None, None), (1, 0, 0), (1, 1, 1)]])
def test_few_labels(spark, rows):
    docs = spark.createDataFrame([(1, "a few words"), (2, None), (None, "idiot " * 40)], "doc_id long, text string")
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for fitted in (quality.scored(docs, quality.fit(docs, labels, F.lit(True))), toxicity.scored(docs, toxicity.fit(docs, labels, F.lit(True)))):
        scores = [r["score"] for r in fitted.collect()]
        assert len(scores) == 3 and all(0 <= s <= 1 for s in scores)
