"""Secrets in texts: patterns, and encoded keys and tokens confirmed by their structure.

Three kinds are found by pattern alone (``assign``, ``access``, ``hex``). Further runs of base64
or hex digits are decoded and reported only if what they hold is built like a secret:

- ``pem``: an armoured block whose content is a key as below, or that is encrypted by its header lines;
- ``key``: a private or public key whose nested DER lengths fit to the last byte;
- ``ssh``: a key file or public key whose length-prefixed parts fit to the last byte;
- ``jwt``: three parts, of which header and content are JSON objects and the header names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import itertools
import json
import re
from collections.abc import Container, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from addrwatch.llm import tables

KINDS = ("assign", "access", "hex", "pem", "key", "ssh", "jwt")
BASE = KINDS[:3]
#: Nested parts of a key are read down to this depth; keys need five at most.
DEPTH = 12

_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
#: Nothing in it is tried twice: no part gives back what it took, and none goes past the next five dashes.
_PEM = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*KEY)-----\s++((?:[A-Za-z][A-Za-z0-9-]*+:(?:(?!-----)[^\n])*+\n(?:[ \t]++(?:(?!-----)[^\n])*+\n)*+)*+)"
    r"([A-Za-z0-9+/=\s]++)-----END \1-----", re.ASCII)
_CIPHER = re.compile(r"Proc-Type:\s*4,\s*ENCRYPTED\s[\s\S]*DEK-Info:", re.ASCII)
#: Lines of base64 digits under each other, and where in them a key may start.
_LINES = re.compile(r"[A-Za-z0-9+/_-]{32,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)*")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_START = re.compile(r"M[A-P]|AAAA[A-Za-z0-9+/_-]{2}(?:Nz|Vj|Nr)|b3BlbnNza")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
_HEX_RUN = re.compile(r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Za-z])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(ey[A-Za-z0-9_-]{8,})\.(ey[A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]*)")
#: What key files begin with, and the names public keys begin with.
_MAGIC = b"openssh-key-v1\0"
_NAME = re.compile(rb"(ssh|ecdsa|sk-ssh|sk-ecdsa)-[a-z0-9@.-]+")
_LONGEST_NAME = 256


def decoded(digits: str) -> bytes | None:
    """Bytes of base64 text in either alphabet, with or without padding."""
    try:
        plain = digits.rstrip("=").replace("-", "+").replace("_", "/")
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _parts(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER values that fill a range exactly."""
    out = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, start = data[start], data[start + 1], start + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or start + n > end or not data[start]:
                return None
            size, start = int.from_bytes(data[start : start + n], "big"), start + n
            if size < 0x80:
                return None
        if start + size > end:
            return None
        out.append((tag, start, start + size))
        start += size
    return out


def _sound(data: bytes, start: int, end: int, depth: int = DEPTH) -> bool:
    """Whether a range is filled by DER values, and the constructed ones among them too."""
    found = _parts(data, start, end)
    return found is not None and depth > 0 and all(
        not tag & 0x20 or _sound(data, a, b, depth - 1) for tag, a, b in found)


def is_key(data: bytes | None, start: int = 0, end: int | None = None) -> bool:
    """Whether bytes, or a range of them, are one DER sequence of the shape of a key.

    Only the heads of the values are read, so a range costs what its values do, not its bytes.
    """
    end = len(data or b"") if end is None else end
    if end - start < 16 or data[start] != 0x30 or not _sound(data, start, end):
        return False
    outer = _parts(data, start, end)
    if len(outer) != 1:
        return False
    inner = _parts(data, *outer[0][1:])
    tags = [t for t, _, _ in inner]
    starts_with_name = bool(inner) and inner[0][0] == 0x30 and (
        first := _parts(data, *inner[0][1:])) is not None and bool(first) and first[0][0] == 0x06
    if tags == [0x30, 0x03]:  # public key: algorithm, bits
        return starts_with_name
    if tags == [0x30, 0x04]:  # encrypted private key: algorithm, bytes
        return starts_with_name
    if tags[:1] != [0x02]:
        return False
    if len(tags) >= 6 and set(tags) <= {0x02, 0x30}:  # private key numbers
        return True
    if tags[1:3] == [0x30, 0x04]:  # private key: version, algorithm, bytes
        algorithm = _parts(data, *inner[1][1:])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return tags[1:2] == [0x04] and data[inner[0][1] : inner[0][2]] == b"\x01"  # curve key


def _part_end(data: bytes, at: int) -> int:
    """Where the length-prefixed part at a place ends, or -1."""
    end = at + 4 + int.from_bytes(data[at : at + 4], "big")
    return end if at + 4 <= len(data) and end <= len(data) else -1


def ssh_end(data: bytes, start: int, stops: Container[int], failed: set[int], least: int = 0) -> int:
    """The first of ``stops``, from ``least`` on, at which a key file or public key that starts here ends, or -1.

    Where a part starts says where it ends, so two keys that come to one place go on alike:
    places from which no stop is reached are noted in ``failed`` and never walked again.
    """
    if data.startswith(_MAGIC, start):
        at, more = start + len(_MAGIC), 5
    else:
        at, more = _part_end(data, start), 1
        if at < 0 or at - start > _LONGEST_NAME or not _NAME.fullmatch(data[start + 4 : at]):
            return -1
    for part in range(more):
        if more == 5 and part == 3:
            at += 4  # the number of keys
        at = _part_end(data, at)
        if at < 0:
            return -1
    walked = []
    while at >= 0 and at not in failed:
        if at >= least:
            if at in stops:
                return at
            walked.append(at)
        at = _part_end(data, at) if at < len(data) else -1
    failed.update(walked)
    return -1


def is_ssh(data: bytes | None) -> bool:
    """Whether bytes are a key file or public key of length-prefixed parts."""
    return bool(data) and ssh_end(data, 0, (len(data),), set()) == len(data)


def _object(digits: str) -> dict | None:
    try:
        found = json.loads(decoded(digits) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _der_digits(head: str) -> int:
    """Base64 digits, without padding, of the DER value that begins with these eight."""
    data = decoded(head) or b""
    if len(data) < 6 or data[0] != 0x30:
        return 0
    n, size = (data[1] & 0x7F, 0) if data[1] >= 0x80 else (0, data[1])
    if n > 4:
        return 0
    return -(-8 * (2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else size)) // 6)


def _decodings(digits: str) -> list[bytes]:
    """What the digits from the first, second, third and fourth on decode to, but for a last one that gives no byte."""
    return [decoded(digits[k : len(digits) - ((len(digits) - k) % 4 == 1)]) or b"" for k in range(4)]


def _inside(text: str) -> list[tuple[str, int, int]]:
    """Keys in base64 that go over several lines or start inside a run of digits.

    The lines' digits are decoded once for each of the four places a group of digits can start at; a key is a
    range of one of these.
    """
    out = []
    for m in _LINES.finditer(text):
        pieces = [x.span() for x in _LINE.finditer(text, *m.span())]
        digits = "".join(text[a:b] for a, b in pieces)
        first = list(itertools.accumulate((b - a for a, b in pieces), initial=0))  # digits before each piece
        ends = {total: b for total, (_, b) in zip(first[1:], pieces, strict=True)}
        bytes_of, stops, failed = None, {}, [set() for _ in range(4)]
        done = 0
        for start in _START.finditer(digits):
            at = start.start()
            if at < done:
                continue
            shift, byte = at % 4, at // 4 * 3
            bytes_of = bytes_of or _decodings(digits)
            if digits[at] == "M":
                kind, stop = "key", at + _der_digits(digits[at : at + 8])
                if stop not in ends or stop - at < 32 or not is_key(bytes_of[shift], byte, byte + (stop - at) * 6 // 8):
                    continue
            else:
                kind = "ssh"
                if shift not in stops:
                    stops[shift] = {}
                    for k in ends:
                        if k > shift and (k - shift) % 4 != 1:
                            stops[shift].setdefault((k - shift) * 6 // 8, k)
                end = ssh_end(bytes_of[shift], byte, stops[shift], failed[shift], byte + 24)
                if end < 0:
                    continue
                stop = stops[shift][end]
            end = ends[stop]
            end += len(text[end : end + 2]) - len(text[end : end + 2].lstrip("="))
            piece = bisect.bisect_right(first, at) - 1
            out.append((kind, pieces[piece][0] + at - first[piece], end))
            done = stop
    return out


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then in the order of KINDS."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            data = decoded("".join(m[3].split()))
            # What an encrypted block holds shows no structure but whole cipher blocks.
            if is_key(data) or is_ssh(data) or data and len(data) % 8 == 0 and _CIPHER.match(m[2]):
                out.append(("pem", m.start(), m.end()))
    for m in _RUN.finditer(text):
        if m[0][0] == "M" and is_key(decoded(m[0])):
            out.append(("key", m.start(), m.end()))
        elif m[0].startswith(("AAAA", "b3BlbnNz")) and is_ssh(decoded(m[0])):
            out.append(("ssh", m.start(), m.end()))
    whole = {(kind, b) for kind, _, b in out if kind in ("key", "ssh")}
    armour = [(a, b) for kind, a, b in out if kind == "pem"]  # by start, apart from each other

    def armoured(start: int, end: int) -> bool:
        at = bisect.bisect_right(armour, (start, len(text))) - 1
        return at >= 0 and end <= armour[at][1]

    out += [x for x in _inside(text) if (x[0], x[2]) not in whole and not armoured(*x[1:])]
    for m in _HEX_RUN.finditer(text):
        if m[0].startswith("30") and is_key(bytes.fromhex(m[0])):
            out.append(("key", m.start(), m.end()))
        elif m[0].startswith(("000000", "6f70656e", "6F70656E", "6F70656e", "6f70656E")) and is_ssh(bytes.fromhex(m[0])):
            out.append(("ssh", m.start(), m.end()))
    if "ey" in text:
        for m in _TOKEN.finditer(text):
            header = _object(m[1])
            if header and isinstance(header.get("alg"), str) and _object(m[2]) is not None:
                out.append(("jwt", m.start(), m.end()))
    return sorted(set(out), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every document with ``spans``, an array of (kind, start, end) ordered by start.

    Null and empty texts have none. Rows are judged one by one, repeated ones too; an input
    column named spans is replaced, all others kept.
    """
    plain = docs.select(*tables.without(docs, "spans"))
    names, at = plain.columns, plain.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tables.slices(batch, text_col):
                found = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t or "")] for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, SPANS)], [*names, "spans"])

    kind = "array<struct<kind: string, start: long, end: long>>"
    return tables.mapped(plain, apply, plain.withColumn("spans", F.array().cast(kind)).schema)
