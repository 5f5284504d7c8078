"""Quality from compression: which of two trained zstandard dictionaries shortens a text more.

One dictionary is trained on good, one on bad labelled text. A text is compressed with both,
in short blocks so that the dictionary counts all along it. The difference of the compressed
sizes over their sum, their share of the text's bytes and the text's length are turned into
the probability of label 1 by logistic regression on labelled texts outside the dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from addrwatch.llm import labelled, tables

#: Labelled texts of each class in a dictionary, and the longest of them that is used.
DICTIONARY_ROWS = 1500
DICTIONARY_TEXT_BYTES = 64 << 10
#: Other labelled texts for the calibration.
CALIBRATION_ROWS = 8000
DICTIONARY_BYTES = 110 << 10
BLOCK = 2048


@dataclass
class Model:
    good: bytes
    bad: bytes
    logistic: labelled.Logistic | None = None

    def numbers(self, texts: list[bytes]) -> np.ndarray:
        """Per text: size difference over the sum, share of the bytes and its square, log of the length, a product."""
        packers = [_packer(d) for d in (self.good, self.bad)]
        sizes = np.array([[sum(len(p.compress(t[i : i + BLOCK])) for i in range(0, max(1, len(t)), BLOCK))
                           for p in packers] for t in texts], float).reshape(-1, 2)
        length = np.array([len(t) for t in texts], float)
        difference = (sizes[:, 1] - sizes[:, 0]) / (sizes.sum(axis=1) + 1)
        share = sizes.sum(axis=1) / 2 / (length + 1)
        long = np.log1p(length)
        return np.column_stack((difference, np.minimum(share, 2), np.minimum(share, 2) ** 2, long, difference * long))


def _packer(content: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(content) if content else None
    return zstandard.ZstdCompressor(level=3, dict_data=own, write_content_size=False, write_dict_id=False)


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the text itself where there is too little to train on."""
    blocks = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(4096, sum(map(len, blocks)) // 8)), blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality",
        dictionary_rows: int = DICTIONARY_ROWS, calibration_rows: int = CALIBRATION_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from labelled rows for which ``train`` (over the columns of labels) holds.

    The rows used are bounded: ``dictionary_rows`` of each class with at most
    DICTIONARY_TEXT_BYTES of text, and ``calibration_rows`` others, chosen by a hash of the identifier.
    """
    half = F.pmod(F.xxhash64(id_col, F.lit("half")), F.lit(2))
    source = labelled.chosen(labels, label, train & (half == 0), dictionary_rows, "dictionary", True, id_col)
    texts = labelled.with_texts(docs, source, id_col, text_col)
    texts = texts.where(F.octet_length("text") <= DICTIONARY_TEXT_BYTES).orderBy("doc_id").collect()
    model = Model(*(_dictionary([r["text"].encode() for r in texts if r["label"] == c]) for c in (1, 0)))
    others = labelled.chosen(labels, label, train & (half == 1), calibration_rows, "calibration", id_col=id_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tables.slices(batch, "text"):
                x = shared.value.numbers([(t or "").encode() for t in tables.column(part, "text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [tables.column(part, "label").cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "x"])

    found = labelled.with_texts(docs, others, id_col, text_col).select("label", "text")
    rows = tables.mapped(found, measured, "label int, x array<double>").collect()  # a few numbers per row
    x = np.array([r["x"] for r in rows]).reshape(-1, 5)
    model.logistic = labelled.Logistic(x, np.array([r["label"] for r in rows]))
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every document with ``score``, the probability of label 1; null texts count as empty.

    Without labelled rows every score is 0.5, with one class only the shrunken share of label 1.
    An input column named score is replaced, all others kept; repeated rows score alike.
    """
    plain = docs.select(*tables.without(docs, "score"))
    names, at = plain.columns, plain.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in tables.slices(batch, text_col):
                x = model.numbers([(t or "").encode() for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.logistic.score(x))], [*names, "score"])

    return tables.mapped(plain, apply, plain.withColumn("score", F.lit(0.0)).schema)
