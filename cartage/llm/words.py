"""Words of a text as 64-bit hashes, vectorized with numpy inside tasks.

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only, which is what ``bytes.lower().split()``
yields on UTF-8. A null text has no words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20  # texts hashed at once; bounds a task's working arrays, longer texts go alone

_U = np.uint64
_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(1 << 40, 1 << 62)) | 1
_MASK = (1 << 64) - 1
_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_POSITION = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < size:
        n = 1 << max(20, int(size - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(n, base & _MASK, np.uint64)
            table[0] = 1
            with np.errstate(over="ignore"):
                _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the offset of each text's first word (one more entry than texts)."""
    joined = b" ".join(texts).lower() + b" "
    data = np.frombuffer(joined, np.uint8)
    space = _SPACES[data]
    start = ~space
    start[1:] &= space[:-1]
    starts = np.flatnonzero(start)
    end = space.copy()
    end[0] = False
    end[1:] &= ~space[:-1]
    ends = np.flatnonzero(end)
    up, down = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    words = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    firsts = np.concatenate([[0], np.cumsum(lengths)])
    return words, np.searchsorted(starts, firsts)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Consecutive texts of about ``CHUNK_BYTES``, as (first, end, encoded texts)."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = utf8(text)
        if held and size + len(raw) > CHUNK_BYTES:
            yield first, i, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, len(texts), held


def pieces(raw: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes, cut before white space only, so that no word is cut."""
    at = 0
    while at < len(raw):
        blank = _BLANK.search(raw, at + size)
        end = blank.start() if blank else len(raw)
        yield raw[at:end]
        at = end


def shingle_sets(words: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingle hashes; fewer words than ``width`` make one shingle, none make none."""
    if len(words) >= width:
        full = sum((words[i : len(words) - width + 1 + i] * _POSITION[i] for i in range(1, width)), words[: len(words) - width + 1] * _POSITION[0])
        full = mix(full + _U(width))
    else:
        full = words[:0]
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        n = b - a
        if n >= width:
            yield np.unique(full[a : b - width + 1])
        elif n:
            yield mix(np.sum(words[a:b] * _POSITION[:n], keepdims=True, dtype=np.uint64) + _U(n))
        else:
            yield words[:0]
