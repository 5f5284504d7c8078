"""Token ids of whole texts by a public tokenizer file.

Most of a corpus consists of words seen before, so a text is cut where the tokenizer cuts it
in any case, and each distinct part goes through the tokenizers library once per worker.
Cuts are made only at places that are sure for the two recognised kinds of file; any other
file gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

# Letters that are one code point in every normal form, whose lower case is one code point too.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"  # no apostrophe: it starts contractions


class _Parts(dict):
    """Part of a text to its ids as little-endian bytes; keeps the latest one or two times ``limit`` parts."""

    def __init__(self, compute, limit: int = 250_000):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(part)
        if value is None:
            value = self.compute(part)
        self[part] = value
        return value


class TextTokenizer:
    """ids(text) gives little-endian unsigned 32-bit ids, equal to encoding the whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind = _kind(spec)
        added = spec.get("added_tokens") or []
        self.added = [t["content"] for t in added if not t.get("normalized")]
        self.added_in_any_form = [t["content"].lower() for t in added if t.get("normalized")]
        self.letters = None
        if kind == "words":
            # White space is dropped, and nothing reaches across it.
            self.cut = re.compile(rf"[{_LETTERS}]+(?=[{_MARKS} \n])|[^ \n\r\t]+").findall
            self.letters = re.compile(rf"[{_LETTERS}]+").fullmatch
            self.shape = str.lower
        elif kind == "bytes":
            # White space goes with what follows it, so cuts are made before it only.
            self.cut = re.compile(
                rf" ?[{_LETTERS}]+(?=[{_MARKS} \n])|\n(?=[{_LETTERS}])|\s*\S+(?:(?![ \n\r\t])\s+\S*)*|\s+").findall
            self.letters = re.compile(rf" ?[{_LETTERS}]+").fullmatch
            self.shape = str
        else:
            self.cut = lambda text: [text] if text else []
        self.parts = _Parts(self._part)
        self.byte_letters = _byte_letters()

    def _part(self, part: str) -> bytes:
        if self.letters and self.letters(part):  # one word for the model, without set-up for a text
            mapped = "".join(map(self.byte_letters.__getitem__, self.shape(part).encode()))
            return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        text = text or ""
        if self._may_hold_added_tokens(text):  # these reach across cuts, so the library gets the text whole
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.parts.__getitem__, self.cut(text)))

    def _may_hold_added_tokens(self, text: str) -> bool:
        """Whether the string of an added token is in the text, in any case for those that are looked for in normalised text."""
        if any(t in text for t in self.added):
            return True
        if not self.added_in_any_form:
            return False
        low = text.lower()
        return any(t in low for t in self.added_in_any_form)


def _kind(spec: dict) -> str:
    steps = spec.get("pre_tokenizer") or {}
    model = spec.get("model", {})
    if model.get("type") != "BPE" or model.get("dropout"):
        return "other"
    if (steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space")
            and not spec.get("normalizer")):
        return "bytes"
    parts = [p.get("type") for p in steps.get("pretokenizers", [])]
    forms = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    if parts == ["Split", "ByteLevel"] and forms == ["NFC", "Replace", "Lowercase"]:
        split, level = steps["pretokenizers"]
        if split.get("invert") and split.get("behavior") == "Removed" and not level.get("use_regex", True):
            return "words"
    return "other"


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> TextTokenizer:
    """One per worker and file; a worker keeps it for its next tasks."""
    return TextTokenizer(path)
