"""Quality rules by compression bands: zstandard ratios of a whole document and of its fixed chunks.

Text that repeats itself compresses too well, noise and encoded data hardly at all. How well prose compresses
depends on how much of it there is, so the band of acceptable ratios is a table by length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from cartage.llm.words import pieces, utf8

LEVEL = 3
CHUNK = 2048  # bytes; a last chunk below the shortest band is not judged
MOST_OUTSIDE = 0.25  # of the bytes of all judged chunks, how many may lie in chunks outside their band
LEAST_WORDS = 20
WINDOW = 8  # words of a window that repeats
MOST_REPEATED = 30  # percent of the words that repeated windows may cover

# fixed values: a text of at least so many bytes has a ratio of compressed to plain bytes from low to high. Prose lies near
# the middle, from 0.7 at 128 bytes to 0.35 at 64 KiB; base64 of noise lies above high, from 0.95 at 256 bytes to 0.75
BANDS = (
    (128, 0.40, 1.02),
    (256, 0.38, 0.82),
    (512, 0.36, 0.77),
    (1024, 0.33, 0.73),
    (2048, 0.30, 0.70),
    (4096, 0.27, 0.68),
    (8192, 0.25, 0.66),
    (16384, 0.22, 0.65),
    (65536, 0.18, 0.64),
)

_SPACE, _SYMBOL, _CONTINUES = (np.zeros(256, bool) for _ in range(3))
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL[list(b"#*$%&|<>")] = True
_CONTINUES[0x80:0xC0] = True
_STARTS = np.array([b[0] for b in BANDS])


def band(size: int) -> tuple[float, float] | None:
    """The limits of a text of ``size`` bytes; ``None`` below the shortest band."""
    at = int(np.searchsorted(_STARTS, size, side="right"))
    return BANDS[at - 1][1:] if at else None


def compressed_size(raw: bytes, packer: zstandard.ZstdCompressor) -> int:
    """Bytes of ``raw`` compressed; the output is counted part by part and not kept."""
    stream, size = packer.compressobj(size=len(raw)), 0
    for at in range(0, len(raw), 1 << 20):
        size += len(stream.compress(raw[at : at + (1 << 20)]))
    return size + len(stream.flush())


def _side(ratio: float, limits: tuple[float, float]) -> int:
    return -1 if ratio < limits[0] else int(ratio > limits[1])


def compression(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, int, int, int, str | None]:
    """Ratio of the whole text, chunks judged, chunks below and above their band, and why the text is rejected."""
    limits = band(len(raw))
    if limits is None:
        return None, 0, 0, 0, None
    ratio = compressed_size(raw, packer) / len(raw)
    chunks = {-1: 0, 0: 0, 1: 0}
    held = {-1: 0, 0: 0, 1: 0}
    for at in range(0, len(raw), CHUNK):
        chunk = raw[at : at + CHUNK]
        inner = band(len(chunk))
        if inner:
            side = _side(len(packer.compress(chunk)) / len(chunk), inner)
            chunks[side] += 1
            held[side] += len(chunk)
    most = MOST_OUTSIDE * sum(held.values())
    side = _side(ratio, limits)
    reason = None
    if side:
        reason = "repetitive" if side < 0 else "incompressible"
    elif held[-1] + held[1] > most:
        reason = "repetitive chunks" if held[-1] >= held[1] else "incompressible chunks"
    return ratio, sum(chunks.values()), chunks[-1], chunks[1], reason


def repeated_words(ids: np.ndarray) -> int:
    """Words inside a window of WINDOW words that occurs twice or more. Windows are named exactly, by halves."""
    names, width = ids, 1
    while width < WINDOW:
        if len(names) <= width:
            return 0
        names = np.unique(names[:-width] * (len(ids) + 1) + names[width:], return_inverse=True)[1].astype(np.int64)
        width *= 2
    again = np.bincount(names)[names] > 1
    change = np.zeros(len(ids) + 1, np.int64)
    change[: len(again)] += again
    change[WINDOW : WINDOW + len(again)] -= again
    return int((np.cumsum(change) > 0).sum())


def measures(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text, worked off piece by piece."""
    numbers: dict[bytes, int] = {}
    found, chars, symbols = [np.zeros(0, np.int64)], 0, 0
    for piece in pieces(raw):
        words = piece.split()
        found.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        data = np.frombuffer(piece, np.uint8)
        chars += int((~(_SPACE | _CONTINUES))[data].sum())
        symbols += int(_SYMBOL[data].sum())
    ids = np.concatenate(found)
    lines, repeated = set(), 0
    for line in raw.split(b"\n"):
        if line.strip():
            repeated += line in lines
            lines.add(line)
    return len(ids), chars, symbols, repeated, repeated_words(ids)


_SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "ratio double, n_chunks long, n_low_chunks long, n_high_chunks long, reason string"
)
_TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 3 + [pa.string()]
_NAMES = [part.split()[0] for part in _SCHEMA.split(", ")]


def judge(text: str | None, packer: zstandard.ZstdCompressor) -> tuple:
    """One text's measures and verdicts, in the order of the result's columns."""
    raw = utf8(text)
    counts = measures(raw)
    failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED * counts[0]
    ratio, chunks, low, high, reason = compression(raw, packer)
    return *counts, failed, not failed and reason is None, ratio, chunks, low, high, reason


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        rows = [judge(text.as_py(), packer) for text in batch.column(1)]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *_NAMES])


def quality(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` the counts of plain rules and the verdict of the compression bands.

    ``base_failed``: fewer than LEAST_WORDS words, or windows that repeat cover more than MOST_REPEATED percent of
    them. ``kept`` is false for those, and for texts whose ratio lies outside the band of their length, or of
    whose judged chunk bytes more than MOST_OUTSIDE lie in chunks outside theirs; ``reason`` tells which. Texts
    shorter than the shortest band have no ratio and no reason. A null text counts as empty. Words are
    ``[^\\x20\\x09-\\x0D]+`` and differ by case. Repeated rows are judged alike, null ids pass, other columns are
    ignored; an empty table gives an empty result. One pass, no shuffle; each text is judged by itself.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_judged, f"doc_id {kind}, {_SCHEMA}")


def keep_by_compression(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, columns unchanged, whatever their names."""

    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            yield batch.filter(pa.array([judge(text.as_py(), packer)[6] for text in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
