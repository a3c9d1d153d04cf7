"""Periodic runs of words: recursive frequency splitting, then a lag scan of the segments that survive.

A run of period q holds at least three periods, so each of its words occurs at least three times in it, and in any
segment that contains it. A word that occurs more rarely within its segment therefore cuts the segment; the
parts are judged anew, until nothing is cut any more. What is left is scanned lag by lag for words equal to those
one lag earlier.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartage.llm.words import pieces, utf8

LEAST_WORDS = 24  # words a run has at least
LEAST_PERIODS = 3  # periods a run has at least
ROUNDS = 64  # of splitting; what is not stable by then is scanned as it is, which finds the same runs

Run = tuple[int, int, int]  # start, length, period
Repeat = Callable[[int | None, int], np.ndarray | None]


def numbered_words(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers, and the distinct words; words are split piece by piece."""
    numbers: dict[bytes, int] = {}
    found = [np.zeros(0, np.int64)]
    for piece in pieces(raw):
        words = piece.split()
        found.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
    return np.concatenate(found), list(numbers)


def segments(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of at least LEAST_WORDS words, each of which occurs LEAST_PERIODS times or more within its stretch.

    All stretches of a round are cut together; the next round looks only at those that were cut. A text made so that
    every round cuts off one word at an end is handed on after ROUNDS rounds.
    """
    pending = np.array([[0, len(ids)]], np.int64)
    for _ in range(ROUNDS):
        pending = pending[pending[:, 1] - pending[:, 0] >= LEAST_WORDS]
        if not len(pending):
            return
        lengths = pending[:, 1] - pending[:, 0]
        owner = np.repeat(np.arange(len(pending)), lengths)
        firsts = np.cumsum(lengths) - lengths
        at = np.arange(len(owner)) - firsts[owner] + pending[owner, 0]
        _, which, counts = np.unique(owner * len(ids) + ids[at], return_inverse=True, return_counts=True)
        rare = counts[which] < LEAST_PERIODS
        cut = np.zeros(len(pending), bool)
        cut[owner[rare]] = True
        yield from ((int(a), int(b)) for a, b in pending[~cut])
        # the frequent words of the cut stretches, as stretches between their cuts
        keep = cut[owner] & ~rare
        starts = keep.copy()
        starts[1:] &= ~keep[:-1] | (owner[1:] != owner[:-1])
        ends = keep.copy()
        ends[:-1] &= ~keep[1:] | (owner[1:] != owner[:-1])
        pending = np.stack([at[starts], at[ends] + 1], axis=1)
    yield from ((int(a), int(b)) for a, b in pending)


def _scan(ids: np.ndarray) -> Iterator[Run]:
    """All qualifying runs of one segment, by octaves of lags.

    For the lags above width / 2 up to width, a position's lag is the distance to the last earlier window of
    ``width`` words equal to the one that starts there. Within a run of smallest period q, from its second period
    on, that distance is q (a shorter one would be a shorter period of the run), and just outside it is not; so
    a stretch of positions with one lag is one run, and no lag of a long segment needs a pass of its own.
    """
    n = len(ids)
    names, width = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while LEAST_PERIODS * (width // 2 + 1) <= n and len(names):
        order = np.argsort(names, kind="stable")
        lag = np.zeros(len(names), np.int64)
        again = names[order[1:]] == names[order[:-1]]
        lag[order[1:][again]] = (order[1:] - order[:-1])[again]
        lag[(lag <= width // 2) | (lag > width)] = 0
        turns = np.flatnonzero(lag[1:] != lag[:-1]) + 1
        starts = np.concatenate([[0], turns])
        ends = np.concatenate([turns, [len(lag)]])
        for a, b in zip(starts[lag[starts] > 0], ends[lag[starts] > 0], strict=True):
            q = int(lag[a])
            length = int(b) - 1 + width - (int(a) - q)
            if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
                yield int(a) - q, length, q
        if len(names) <= width:
            return
        # windows of twice the width, named by their two halves
        names = np.unique(names[:-width] * (n + 1) + names[width:], return_inverse=True)[1].astype(np.int64)
        width *= 2


def word_runs(ids: np.ndarray) -> list[Run]:
    """Every maximal run of words, as (start, length, smallest period), by start, then period."""
    return sorted(
        ((a + start, length, q) for a, b in segments(ids) for start, length, q in _scan(ids[a:b])), key=lambda r: (r[0], r[2])
    )


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut down to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def strongest(runs: list[Run]) -> Run | None:
    """The run with most periods; among equals the first, then the one of shortest period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place once a document's tail is made periodic; ``None``: no change.

    One id in ten, by crc32 of the decimal id, repeats its words from some word on.
    """
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _joined(ids: np.ndarray, words: list[bytes]) -> Iterator[bytes]:
    """The words with one space between them, some at a time."""
    step = 1 << 16
    for at in range(0, len(ids), step):
        yield (b" " if at else b"") + b" ".join([words[i] for i in ids[at : at + step]])


def _examine(batches: Iterator[pa.RecordBatch], repeat: Repeat | None, finish, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids, words = numbered_words(utf8(text.as_py()))
            order = repeat(doc_id, len(ids)) if repeat else None
            if order is not None:
                ids = ids[order]
            runs = word_runs(ids)
            rows.append(finish(runs, _joined(ids[kept_words(len(ids), runs)], words)))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *schema.names])


_FOUND = pa.schema([
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string()),
])
_DIGESTS = pa.schema([
    ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
    ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])


def _found(runs: list[Run], kept: Iterator[bytes]) -> tuple:
    return [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], b"".join(kept).decode("utf-8", "replace")


def _digested(runs: list[Run], kept: Iterator[bytes]) -> tuple:
    best = strongest(runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    collapsed = hashlib.sha256()
    for part in kept:
        collapsed.update(part)
    return len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), collapsed.hexdigest()


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def periodic_runs(docs: DataFrame, repeat: Repeat | None = None) -> DataFrame:
    """``(doc_id, runs, collapsed)`` per row of ``docs``: all runs of the text's words, and its words without repeats.

    ``runs`` holds structs (start, length, period), word numbers from 0, by start, then period. ``collapsed`` joins
    by one space the words that no run repeats. Words are ``[^\\x20\\x09-\\x0D]+`` and differ by case. ``repeat`` may
    rearrange a document's words before they are judged. Null and blank texts have no runs and collapse to the
    empty text. Repeated rows are judged alike, null ids pass, other columns are ignored; an empty table gives an
    empty result. One pass, no shuffle; a text of n words takes time in proportion to n log(n)^2 at most.
    """
    schema = f"doc_id {_kind(docs)}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(lambda b: _examine(b, repeat, _found, _FOUND), schema)


def run_digests(docs: DataFrame, repeat: Repeat | None = repeated_tail) -> DataFrame:
    """Per row of ``docs`` the number of runs, the strongest run, and digests of all runs and of the collapsed text.

    Rows are judged as by ``periodic_runs``; without runs the four columns of the strongest one are null. A null id
    rearranges nothing.
    """
    numbers = "n_runs long, start long, length long, period long, exponent_milli long"
    schema = f"doc_id {_kind(docs)}, {numbers}, runs_sha256 string, collapsed_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(lambda b: _examine(b, repeat, _digested, _DIGESTS), schema)
