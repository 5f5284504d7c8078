"""Windows of benchmark words in documents, against a plain search."""

from __future__ import annotations

import random
import re

from addrwatch.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, window, one_in):
    split = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w = split(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out[doc] = (len(w), len(hit), sorted(found), bool(hit) and one_in * len(hit) >= len(w))
    return out


def cases():
    rng = random.Random(5)
    word = lambda: rng.choice(["aa", "Bb", "cé", "1", "of", "THE", "Ünder"])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "_", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 8]))) for i in range(12)] + [(12, None), (13, "?!"), (14, "aa aa aa aa")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(60)] + [(60, None), (61, ""), (62, "aa " * 40), (63, "...")]
    return docs, items


def test_hits_are_those_of_a_plain_search(spark):
    docs, items = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for pass_bytes in (1 << 20, 100):  # one pass, and several
        got = decontamination.contamination(d, b, window=4, one_in=3, pass_bytes=pass_bytes).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in got} == plain(docs, items, 4, 3)


def test_long_texts_and_windows_across_stretches():
    import pyarrow as pa

    from addrwatch.llm import words
    rng = random.Random(1)
    doc = [str(rng.randrange(30)) for _ in range(5000)]
    windows = decontamination.Windows([("x", " ".join(doc[505:525])), ("y", " ".join(doc[4987:]))], 13)
    items, hit = decontamination._marks(words.read(pa.array([" ".join(doc), "1 2"])), windows)
    assert items == [{"x", "y"}, set()]
    assert set(range(505, 525)) | set(range(4987, 5000)) <= set(hit.nonzero()[0].tolist()) and hit.sum() == 33


def test_empty_benchmark(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(d, b).first()["contaminated"] is False
