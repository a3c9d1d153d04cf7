"""Secrets in texts: keyword automaton first, anchored patterns only at its hits, checksums where a kind has one.

Spans are code points, end exclusive. Base kinds: ``assign`` (a password, token or key being assigned),
``access`` (access key ids) and ``hex`` (long lower-case hexadecimal runs). The method adds ``github`` and
``npm``: prefixed tokens whose last six characters are the base-62 CRC-32 of the characters before them.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "github", "npm")
MASK = "[REDACTED]"

# fixed values: the formats of the kinds
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_PREFIXED = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_ASSIGN_LEAST, _ACCESS_LEAST, _HEX_LEAST = 8, 16, 32
_KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
_DIGITS = string.digits + string.ascii_uppercase + string.ascii_lowercase

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_HEX_CLASS = bytes(104 if chr(i) in "0123456789abcdef" else 46 for i in range(256))
_HEX_HIT = b"h" * _HEX_LEAST

_automaton = None


def _keywords():
    global _automaton
    if _automaton is None:
        _automaton = ahocorasick.Automaton()
        for kind, words in _KEYWORDS.items():
            for word in words:
                _automaton.add_word(word, (kind, len(word)))
        _automaton.make_automaton()
    return _automaton


def checksum(body: bytes) -> bytes:
    """Six base-62 digits of the CRC-32 of ``body``, leading zeros kept."""
    value, digits = zlib.crc32(body), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = _DIGITS[rest] + digits
    return digits.encode()


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start, then kind in the order of KINDS; leftmost and apart within a kind."""
    if not text:
        return []
    raw = text.encode("latin-1", "replace")  # one byte per code point; what is beyond is in no pattern's classes
    spans, done = [], dict.fromkeys(KINDS, 0)
    for last, (kind, size) in _keywords().iter(raw.translate(_LOWER).decode("latin-1")):
        at = last - size + 1
        if at < done[kind]:
            continue
        if kind == "assign":
            if found := _ASSIGN.match(raw, at):
                done[kind] = found.end()
                if len(found[2]) >= _ASSIGN_LEAST:
                    spans.append((at, found.end(), kind))
        elif kind == "access":
            if found := _ACCESS.match(raw, at):
                done[kind] = found.end()
                if found.end() - at >= _ACCESS_LEAST:
                    spans.append((at, found.end(), kind))
        elif (found := _PREFIXED.match(raw, at)) and checksum(found[1]) == found[2]:
            done[kind] = found.end()
            spans.append((at, found.end(), kind))
    classes = raw.translate(_HEX_CLASS)
    at = classes.find(_HEX_HIT)
    while at >= 0:
        end = _HEX.match(raw, at).end()
        spans.append((at, end, "hex"))
        at = classes.find(_HEX_HIT, end)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def redacted(text: str | None) -> str | None:
    """``text`` with every span replaced by MASK; spans that overlap become one."""
    if text is None:
        return None
    parts, at = [], 0
    for start, end, _ in find_spans(text):
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if parts else text


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = KINDS[:3]
    for batch in batches:
        out: dict[str, list] = {name: [] for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for text in batch.column("text"):
            spans = find_spans(text.as_py())
            kinds = [kind for _, _, kind in spans]
            for kind in base:
                out[f"n_{kind}"].append(kinds.count(kind))
            out["base_sha256"].append(hashlib.sha256(_joined([s for s in spans if s[2] in base]).encode()).hexdigest())
            out["spans"].append(_joined(spans))
        types = [pa.int64()] * 3 + [pa.string()] * 2
        columns = [pa.array(out[name], kind) for name, kind in zip(out, types, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *out])


def secret_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` per row of ``docs``.

    A null or empty text has no spans. Kinds are searched independently, so spans of different kinds may
    overlap. Repeated rows and null doc_ids are passed through row by row; other columns are ignored.
    One pass without a shuffle.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scan_batches,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, spans string",
    )


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text``; ``n_chars``, where there is one, follows. Every row stays."""
    schema = docs.schema
    at = schema.fieldNames().index("text")
    counted = schema.fieldNames().index("n_chars") if "n_chars" in schema.fieldNames() else None

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            before = columns[at].to_pylist()
            after = [redacted(text) for text in before]
            columns[at] = pa.array(after, columns[at].type)
            if counted is not None:
                sizes = zip(before, after, columns[counted].to_pylist(), strict=True)
                columns[counted] = pa.array([n if a is b else len(a) for b, a, n in sizes], columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(mask, schema)


