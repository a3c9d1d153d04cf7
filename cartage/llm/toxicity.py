"""Toxicity scores by weak supervision.

Many voters (words and word beginnings of a lexicon that labelled rows suggest, and patterns) vote on a
bounded sample. A generative label model estimates the class prior, every voter's accuracy and which voters
err together; its posterior labels train a linear classifier over hashed words and word beginnings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartage.llm.sampling import bounded, fold
from cartage.llm.words import chunks, hashed_words, mix
from cartage.session import materialize, scratch

BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)  # word beginnings in bytes, for inflected words
SAMPLE = 8000  # labelled rows per class that fitting may use; the only bound on what is learned from
VOTERS = 192  # lexicon voters
WEIGHTS = 8192  # features of the classifier
LEAST_SIGNIFICANCE = 3.0
TOGETHER = 0.4  # correlation within a class from which voters share one vote
ROUNDS, EPOCHS = 15, 30
CUT = 0.3

_U = np.uint64
_SALT = mix(np.arange(11, 11 + len(PREFIXES) + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
# letters of ASCII lower-cased, other ASCII bytes a space; bytes of other letters stay
_LETTERS = bytes(ord(chr(i).lower()) if chr(i).isalpha() else 32 for i in range(128)) + bytes(range(128, 256))
PATTERNS = ("shouting", "exclaiming", "repeating")


def features(raw: list[bytes]) -> Iterator[np.ndarray]:
    """Per text its distinct buckets: words, beginnings of words, and patterns (the first buckets)."""
    plain = [text.translate(_LETTERS) for text in raw]
    words, offsets = hashed_words(plain)
    joined = np.frombuffer(b" ".join(plain) + b" " * 8, np.uint8)
    space = joined == 32
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    kinds = [mix(words + _SALT[0])]
    for salt, size in zip(_SALT[1:], PREFIXES, strict=True):
        begun, live = np.zeros(len(starts), np.uint64), np.ones(len(starts), bool)
        for k in range(size):
            byte = joined[starts + k]
            live &= byte != 32
            begun = (begun << _U(8)) | byte.astype(np.uint64)
        kinds.append(np.where(live, mix(begun + salt), mix(words + _SALT[0])))
    buckets = np.stack(kinds) % _U(BUCKETS - len(PATTERNS)) + _U(len(PATTERNS))
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        n = b - a
        distinct = len(np.unique(words[a:b]))
        letters = np.frombuffer(raw[i], np.uint8)
        upper = int(((letters >= 65) & (letters <= 90)).sum())
        lower = int(((letters >= 97) & (letters <= 122)).sum())
        patterns = np.flatnonzero([upper > lower, raw[i].count(b"!") * 10 > n > 0, n >= 20 and distinct * 3 < n])
        yield np.union1d(patterns, buckets[:, a:b].ravel().astype(np.int64))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            f.astype(np.int32).tobytes() for _, _, raw in chunks(batch.column("text").to_pylist()) for f in features(raw)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.binary())], names=["doc_id", "toxic", "features"]
        )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _shared_votes(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """A weight per voter: one over the number of voters it is correlated with once the class is known."""
    residual = votes - np.outer(posterior, votes.T @ posterior / max(posterior.sum(), 1e-9))
    residual -= np.outer(1 - posterior, votes.T @ (1 - posterior) / max((1 - posterior).sum(), 1e-9))
    spread = np.sqrt((residual**2).mean(axis=0)) + 1e-9
    correlation = residual.T @ residual / len(votes) / np.outer(spread, spread)
    return 1 / np.maximum(1, (np.abs(correlation) >= TOGETHER).sum(axis=0))


def label_model(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Posterior of class 1 per row, by expectation maximization.

    The given label is one more voter, with an accuracy of its own per class; rows carry ``weights``
    that undo the sampling by class.
    """
    posterior = np.where(labels == 1, 0.95, 0.05)
    for _ in range(ROUNDS):
        one, zero = weights * posterior, weights * (1 - posterior)
        prior = np.log((one.sum() + 1) / (zero.sum() + 1))
        shares = _shared_votes(votes, posterior)
        yes, no = (votes.T @ one + 0.5) / (one.sum() + 1), (votes.T @ zero + 0.5) / (zero.sum() + 1)
        hit, false = ((labels * one).sum() + 1) / (one.sum() + 2), ((labels * zero).sum() + 1) / (zero.sum() + 2)
        odds = prior + votes @ (shares * np.log(yes / no)) + (1 - votes) @ (shares * np.log((1 - yes) / (1 - no)))
        odds += np.where(labels == 1, np.log(hit / false), np.log((1 - hit) / (1 - false)))
        posterior = _sigmoid(odds)
    return posterior


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def score(self, buckets: np.ndarray) -> float:
        return float(_sigmoid(self.weights[buckets].sum() + self.bias))


def _fit(rows: list[np.ndarray], labels: np.ndarray, importance: np.ndarray) -> ToxicityModel:
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ones, zeros = max(1, (labels == 1).sum()), max(1, (labels == 0).sum())
    p = np.bincount(flat, weights=labels[owner], minlength=BUCKETS)
    q = np.bincount(flat, minlength=BUCKETS) - p
    share = (p + q) / len(rows)
    deviation = np.sqrt(share * (1 - share) * (1 / ones + 1 / zeros)) + 1e-9
    signal = (p / ones - q / zeros) / deviation
    signal[p + q < 4] = 0
    lexicon = np.argsort(-signal, kind="stable")[:VOTERS]
    lexicon = lexicon[signal[lexicon] >= LEAST_SIGNIFICANCE]
    voters = np.union1d(lexicon, np.arange(len(PATTERNS)))
    number = np.full(BUCKETS, -1)
    number[voters] = np.arange(len(voters))
    votes = np.zeros((len(rows), len(voters)))
    cast = number[flat] >= 0
    votes[owner[cast], number[flat[cast]]] = 1
    posterior = label_model(votes, labels, importance)

    # logistic regression on the most telling features, towards the posterior
    chosen = np.argsort(-np.abs(signal), kind="stable")[:WEIGHTS]
    chosen = np.sort(chosen[np.abs(signal[chosen]) >= LEAST_SIGNIFICANCE])
    number = np.full(BUCKETS, -1)
    number[chosen] = np.arange(len(chosen))
    keep = number[flat] >= 0
    columns, owners = number[flat[keep]], owner[keep]
    weight, bias = np.zeros(len(chosen)), float(np.log((importance @ posterior + 1) / (importance @ (1 - posterior) + 1)))
    squares, square = np.zeros(len(chosen)), 0.0
    random = np.random.default_rng(11)
    group = random.integers(0, max(1, len(rows) // 256), len(rows))
    order = np.argsort(group[owners], kind="stable")
    columns, owners = columns[order], owners[order]
    bounds = np.searchsorted(group[owners], np.arange(group.max() + 2))
    scale = importance / importance.mean()
    for _ in range(EPOCHS):
        for g in random.permutation(group.max() + 1):
            members = np.flatnonzero(group == g)
            local = np.searchsorted(members, owners[bounds[g] : bounds[g + 1]])
            here = columns[bounds[g] : bounds[g + 1]]
            odds = np.bincount(local, weights=weight[here], minlength=len(members)) + bias
            error = (_sigmoid(odds) - posterior[members]) * scale[members]
            slope = np.bincount(here, weights=error[local], minlength=len(chosen)) / len(members)
            used = np.flatnonzero(slope)
            step = slope[used] + 1e-5 * weight[used]
            squares[used] += step**2
            weight[used] -= 0.3 * step / np.sqrt(squares[used] + 1e-8)
            square += error.mean() ** 2
            bias -= 0.1 * error.mean() / np.sqrt(square + 1e-8)
    dense = np.zeros(BUCKETS)
    dense[chosen] = weight
    return ToxicityModel(dense, bias)


def train_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """A model from labelled rows whose crc32(doc_id) mod 4 is not 2, at most about ``sample`` per class.

    Class sizes are counted over all such labels. A doc_id that is labelled twice counts as toxic if any label says so.
    """
    uri = scratch(docs.sparkSession, "toxicity")
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    known = known.where(fold(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known, f"{uri}/labels")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = materialize(bounded(known, "toxic", sample), f"{uri}/drawn")  # about 2 * sample rows
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(drawn), "doc_id")
    found = rows.select("doc_id", "toxic", "text").mapInArrow(_feature_batches, "doc_id long, toxic int, features binary").collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    classes = np.array([r["toxic"] for r in found], int)
    if len(set(classes)) < 2:
        total = sum(sizes.values())
        return ToxicityModel(np.zeros(BUCKETS), float(np.log((sizes.get(1, 0) + 1) / (total - sizes.get(1, 0) + 1))))
    importance = np.array([sizes[0] / (classes == 0).sum(), sizes[1] / (classes == 1).sum()])[classes]
    return _fit([np.frombuffer(r["features"], np.int32) for r in found], classes.astype(float), importance)


def _score_batches(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                model.score(f) for _, _, raw in chunks(batch.column("text").to_pylist()) for f in features(raw)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, model: ToxicityModel | None = None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``.

    Only the text decides a score; null and empty texts get the score of a text without any telling word.
    Null doc_ids are neither learned from nor held out (``held_out`` false). Without labels of both classes
    every text gets the share of toxic labels. Repeated rows are scored alike, other columns are ignored. One
    pass without a shuffle after fitting.
    """
    model = model or train_toxicity(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_score_batches(model), f"doc_id {kind}, score double")
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
