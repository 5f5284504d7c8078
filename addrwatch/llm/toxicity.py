"""Toxicity from a weighted lexicon, found by an Aho-Corasick automaton in folded text.

Folding makes letters out of look-alikes (other scripts, full width, accents, digits and signs
that stand for letters), so that a disguised word meets its entry. Entries are word beginnings,
so one covers the inflected forms of a stem. Phrases in which an entry is harmless are
exceptions: a match inside one doesn't count. The weights of the matches, by themselves and
over the number of words, give the probability of label 1 by logistic regression.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from addrwatch.llm import labelled, tables, words

#: Labelled rows that lexicon, exceptions and calibration are learned from.
TRAIN_ROWS = 20_000
SHORTEST, LONGEST = 4, 12
#: An entry is in so many toxic documents at least, and such a share is toxic of those that have it.
MIN_DOCS, MIN_SHARE = 4, 0.5
#: Entries that chance may be expected to bring in.
FALSE_ENTRIES = 0.01
MAX_ENTRIES = 2000
#: A longer beginning of a kept one is kept too if its weight is greater by so much.
PURER = 1.0

# Characters of other scripts and signs that look like a letter, beside those that
# compatibility decomposition turns into one.
LOOK_ALIKES = {
    "a": "аαɑ@4", "b": "вЬ8", "c": "сϲ", "d": "ԁɗ", "e": "еεє3", "g": "ɡ", "h": "һн", "i": "іιıl1|ⅼӏ", "j": "јϳ",
    "k": "кκ", "m": "мⅿ", "n": "ո", "o": "оοσ0", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ5$", "t": "тτ7", "u": "υս",
    "v": "νѵ", "w": "ԝѡω", "x": "хχ", "y": "уγү", "z": "ᴢ",
}


def _folds() -> dict[int, str]:
    alike = {ord(c): letter for letter, chars in LOOK_ALIKES.items() for c in chars}
    table = {}
    for code in [*range(0x250), *range(0x370, 0x590), *range(0x1E00, 0x2000), *range(0xFF00, 0xFF60)]:
        base = unicodedata.normalize("NFKD", chr(code)).lower()
        base = "".join(c for c in base if not unicodedata.combining(c))[:1] or " "
        base = alike.get(ord(base), base)
        table[code] = base if base.isalnum() else " "
    table |= {c: "" for c in (*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF)}  # marks, invisible
    return table | alike | {ord("|"): " "}


FOLDS = _folds()


def fold(text: str) -> str:
    """Letters in place of their look-alikes, blanks in place of other signs, a blank at each end."""
    return f" {text.lower().translate(FOLDS)} "


@dataclass
class Lexicon:
    """Weight of each entry (a folded word beginning) and folded exception phrases."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    logistic: labelled.Logistic | None = None
    _machine: object = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_machine": None}

    def machine(self):
        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for phrase in self.exceptions:
                self._machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
            for entry in self.weights:
                self._machine.add_word(f" {entry}", (len(entry) + 1, entry))
            self._machine.make_automaton()
        return self._machine

    def matches(self, text: str) -> tuple[list[tuple[str, int]], int]:
        """Entries with the place of their word in the folded text, and the number of words.

        Of the entries that begin a word the longest counts.
        """
        folded = fold(text)
        found: dict[int, str] = {}
        harmless: list[tuple[int, int]] = []
        if len(self.machine()):
            for end, (size, entry) in self.machine().iter(folded):
                if entry is None:
                    harmless.append((end + 1 - size, end))
                else:
                    found[end + 1 - size] = entry
        kept = [(e, at) for at, e in found.items() if not any(a <= at < b for a, b in harmless)]
        return kept, len(folded.split())

    def numbers(self, texts: Sequence[str | None]) -> np.ndarray:
        """Per text: log of the summed weights, log of the sum per hundred words, the greatest weight."""
        out = []
        for text in texts:
            found, n = self.matches(text or "")
            total = sum(self.weights[e] for e, _ in found)
            out.append((np.log1p(total), np.log1p(100 * total / max(1, n)), max((self.weights[e] for e, _ in found), default=0.0)))
        return np.array(out, float).reshape(-1, 3)


def _beginnings(text: str) -> set[str]:
    return {w[:k] for w in set(fold(text).split()) for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", rows: int = TRAIN_ROWS,
        exceptions: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """Learns from at most ``rows`` labelled rows for which ``train`` (over the columns of labels) holds.

    Word beginnings are counted per class, near copies of a document once. An entry must be
    in more toxic documents than chance explains, all beginnings tried considered; of
    beginnings of one another, the one with the greatest likelihood ratio is taken, the
    longest of equals, and longer ones that tell much more. Two-word phrases around an entry that are in clean documents and in no
    toxic one become exceptions, beside the given ones.
    """
    picked = labelled.chosen(labels, label, train, rows, "lexicon", id_col=id_col)
    texts = tables.mapped(labelled.with_texts(docs, picked, id_col, text_col).select("label", "text"), _keyed,
                          "label int, text string, key long")
    texts = tables.stored(texts.dropDuplicates(["label", "key"]), "toxicity-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(tables.column(batch, "text").to_pylist(), tables.column(batch, "label").to_pylist(), strict=True):
                seen[y].update(_beginnings(text))
            if len(seen[0]) + len(seen[1]) > 500_000:
                yield _counts(*seen)
                seen = (Counter(), Counter())
        yield _counts(*seen)

    sums = (tables.mapped(texts.select("text", "label"), counted, "entry string, clean long, toxic long")
            .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    sizes = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    rate = _rate(sizes.get(1, 0), sizes.get(0, 0))
    t, c = F.col("toxic"), F.col("clean")
    gain = t * F.log(t / (t + c) / rate) + F.when(c > 0, c * F.log(c / (t + c) / (1 - rate))).otherwise(0)
    tried = sums.count()
    likely = (sums.where((t >= MIN_DOCS) & (t >= MIN_SHARE * (t + c))).withColumn("gain", gain)
              .orderBy(F.desc("gain"), F.desc(F.length("entry")), "entry").limit(20 * MAX_ENTRIES).collect())
    counts = {r["entry"]: (r["toxic"], r["clean"]) for r in likely}
    lexicon = Lexicon(_selected(counts, sizes.get(1, 0), sizes.get(0, 0), tried))
    lexicon.exceptions = (*(fold(p).strip() for p in exceptions), *_harmless(texts, lexicon))
    rows_ = _measured(texts, lexicon)
    lexicon.logistic = labelled.Logistic(np.array([r["x"] for r in rows_]).reshape(-1, 3), np.array([r["label"] for r in rows_]))
    return lexicon


def _counts(clean: Counter, toxic: Counter) -> pa.RecordBatch:
    entries = sorted(clean.keys() | toxic.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(entries, pa.string()), pa.array([clean[e] for e in entries], pa.int64()),
         pa.array([toxic[e] for e in entries], pa.int64())], ["entry", "clean", "toxic"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least hash of five words in a row, which near copies mostly share."""
    for batch in batches:
        for part in tables.slices(batch, "text"):
            text = words.read(tables.column(part, "text"))
            n = max(0, len(text.hashes) - 4)
            runs = sum((text.hashes[k : k + n] * np.uint64(2 * k + 3) for k in range(5)), np.zeros(n, np.uint64))
            keys = [int(words.mix(runs[a : b - 4]).min() if b - a > 4 else words.mix(text.hashes[a:b].sum(keepdims=True))[0])
                    for a, b in zip(text.first, text.first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [tables.column(part, "label").cast(pa.int32()), tables.column(part, "text"),
                 pa.array(np.array(keys, np.uint64).view(np.int64))], ["label", "text", "key"])


def _selected(counts: dict[str, tuple[int, int]], toxic: int, clean: int, tried: int) -> dict[str, float]:
    """Weights of the entries kept, out of (toxic, clean) document counts."""
    rate = _rate(toxic, clean)
    gains, weights = {}, {}
    for entry, (t, c) in counts.items():
        tail = sum(math.exp(_log_binomial(t + c, k, rate)) for k in range(t, t + c + 1))
        if tail * tried <= FALSE_ENTRIES:
            share = t / (t + c)
            gains[entry] = t * math.log(share / rate) + (c * math.log((1 - share) / (1 - rate)) if c else 0.0)
            weights[entry] = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
    kept: dict[str, float] = {}
    for entry in sorted(gains, key=lambda e: (-round(gains[e], 9), -len(e), e)):
        shorter = [k for k in kept if entry.startswith(k)]
        longer = any(k.startswith(entry) for k in kept)
        if not longer and all(weights[entry] > kept[k] + PURER for k in shorter) and len(kept) < MAX_ENTRIES:
            kept[entry] = weights[entry]
    return {e: w for e, w in kept.items() if w > 0}


def _rate(toxic: int, clean: int) -> float:
    """Share of toxic documents, kept off 0 and 1."""
    return min(max(toxic, 0.5) / max(1, toxic + clean), 0.999)


def _log_binomial(n: int, k: int, rate: float) -> float:
    return (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
            + k * math.log(rate) + (n - k) * math.log(1 - rate))


def _harmless(texts: DataFrame, lexicon: Lexicon) -> list[str]:
    """Two-word phrases around a match in at least MIN_DOCS clean and no toxic documents."""
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ys = [], []
            for text, y in zip(tables.column(batch, "text").to_pylist(), tables.column(batch, "label").to_pylist(), strict=True):
                found, _ = shared.value.matches(text)
                folded = fold(text)
                own = set()
                for _, at in found:
                    around = [*folded[max(0, at - 40) : at].split()[-1:], *folded[at : at + 80].split()[:2]]
                    own |= {" ".join(pair) for pair in zip(around, around[1:], strict=False)}
                out += sorted(own)
                ys += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(ys, pa.int32())], ["phrase", "label"])

    counts = tables.mapped(texts.select("text", "label"), phrases, "phrase string, label int").groupBy("phrase").agg(
        F.count_if(F.col("label") == 0).alias("clean"), F.count_if(F.col("label") == 1).alias("toxic"))
    found = counts.where(f"toxic = 0 AND clean >= {MIN_DOCS}").orderBy(F.desc("clean"), "phrase").limit(MAX_ENTRIES)
    return [r["phrase"] for r in found.collect()]


def _measured(texts: DataFrame, lexicon: Lexicon) -> list:
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shared.value.numbers(tables.column(batch, "text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [tables.column(batch, "label").cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "x"])

    return tables.mapped(texts.select("text", "label"), measured, "label int, x array<double>").collect()  # bounded by the sample


def scored(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """Every document with ``score``, the probability of label 1, and ``toxic_terms`` it matched.

    Null texts count as empty. Without labelled rows every score is 0.5, with one class only the
    shrunken share of label 1. Input columns named like a result are replaced, all others
    kept; repeated rows score alike.
    """
    plain = docs.select(*tables.without(docs, "score", "toxic_terms"))
    names, at = plain.columns, plain.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            for part in tables.slices(batch, text_col):
                texts = part.column(at).to_pylist()
                terms = [sorted({e for e, _ in lexicon.matches(t or "")[0]}) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lexicon.logistic.score(lexicon.numbers(texts))), pa.array(terms, pa.list_(pa.string()))],
                    [*names, "score", "toxic_terms"])

    schema = plain.withColumns({"score": F.lit(0.0), "toxic_terms": F.array().cast("array<string>")}).schema
    return tables.mapped(plain, apply, schema)
