"""Language identification: averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

A text's letters, lower-cased, are cut into byte n-grams; each is hashed to a row of an embedding table,
the rows are averaged and a softmax over the languages is taken. Table and softmax are fitted by
stochastic gradient descent in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartage.llm.sampling import fold
from cartage.llm.words import CHUNK_BYTES, utf8
from cartage.session import materialize, scratch

BUCKETS = 1 << 14
WIDTH = 16  # embedding dimensions
SAMPLE = 1500  # labelled rows per language that training may use; the only bound on what is learned from
TOTAL = 40_000  # labelled rows of all languages together; with more languages than TOTAL / SAMPLE each gives fewer
EPOCHS, BATCH, RATE = 5, 64, 0.1
KEPT_SHARE = 0.999  # of the validation rows labelled rightly, how many the rejection threshold keeps at least
EVEN_GUESS = 0.5  # the threshold is never above this
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = np.zeros(256, bool)
_NOT_LETTERS[[i for i in range(128) if not chr(i).isalpha()]] = True
_HASH = np.uint32(2654435761)
_BUCKET = np.uint16  # holds a bucket's number


def subwords(text: str | None) -> np.ndarray:
    """Buckets of the byte n-grams (2 to 4) of a text; whatever is no letter becomes one space."""
    data = np.frombuffer(b" " + utf8(text).lower() + b" ", np.uint8)
    blank = _NOT_LETTERS[data]
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[0] = True
    codes = np.where(blank, 32, data)[keep].astype(np.uint32)
    found = []
    gram = codes
    for size in (2, 3, 4):
        gram = (gram[:-1] << np.uint32(8)) | codes[size - 1 :]
        if not len(gram):
            break
        found.append(((gram * _HASH) ^ np.uint32(size * 40503)) >> np.uint32(32 - 14))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def bucket_counts(text: str | None) -> np.ndarray:
    """How often each bucket occurs; worked off in pieces, so a long text needs no more memory than a short one."""
    text = text or ""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(text), 1), CHUNK_BYTES):
        counts += np.bincount(subwords(text[at : at + CHUNK_BYTES]), minlength=BUCKETS)
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    embedding: np.ndarray  # BUCKETS x WIDTH
    weights: np.ndarray  # WIDTH x languages
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        total = max(1, counts.sum())
        hidden = counts @ self.embedding / total
        return _softmax(((hidden @ self.weights + self.bias) / self.temperature)[None])[0]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0
        chances = self.scores(bucket_counts(text))
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buckets, counts = [], []
        for text in batch.column("text"):
            dense = bucket_counts(text.as_py())
            at = np.flatnonzero(dense)
            buckets.append(at.astype(_BUCKET).tobytes())
            counts.append(dense[at].astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("part"), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())],
            names=["lang", "part", "buckets", "counts"],
        )


def _softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def _descend(rows: list[tuple[np.ndarray, np.ndarray]], wanted: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, weights and biases after EPOCHS of mini-batch gradient steps.

    Every number's step is its slope over the root of its squared slopes so far, so no step exceeds RATE whatever the
    texts are, and after t steps no number has moved by more than 2 RATE sqrt(t).
    """
    random = np.random.default_rng(5)
    parts = [random.normal(0, 0.1, (BUCKETS, WIDTH)), random.normal(0, 0.1, (WIDTH, languages)), np.zeros(languages)]
    embedding, weights, bias = parts
    squares = [np.full(p.shape, 1e-10) for p in parts]

    def step(part: int, slope: np.ndarray, at=slice(None)) -> None:
        squares[part][at] += slope * slope
        parts[part][at] -= RATE * slope / np.sqrt(squares[part][at])

    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for first in range(0, len(order), BATCH):
            picked = order[first : first + BATCH]
            used = np.zeros(BUCKETS, bool)
            for i in picked:
                used[rows[i][0]] = True
            place = np.cumsum(used) - 1
            used = np.flatnonzero(used)
            shares = np.zeros((len(picked), len(used)))
            for n, i in enumerate(picked):
                shares[n, place[rows[i][0]]] = rows[i][1]
            hidden = shares @ embedding[used]
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(picked)), wanted[picked]] -= 1
            error /= len(picked)
            back = error @ weights.T
            step(1, hidden.T @ error)
            step(2, error.sum(axis=0))
            step(0, shares.T @ back, used)
    if not all(np.isfinite(p).all() for p in parts):
        raise FloatingPointError("the language model has weights that are not finite")
    return embedding, weights, bias


def fit_languages(found: list[tuple[str, int, np.ndarray, np.ndarray]]) -> LanguageModel:
    """A model from rows (language, part, buckets, their counts); part 0 calibrates, the others train.

    Languages that have calibrating rows only train with those.
    """
    languages = sorted({lang for lang, *_ in found})
    rows = [(at, (counts / counts.sum()).astype(np.float32)) for _, _, at, counts in found]
    wanted = np.array([languages.index(lang) for lang, *_ in found], int)
    parts = np.array([part for _, part, *_ in found], int)
    trained = np.isin(wanted, wanted[parts > 0])
    train, held = np.flatnonzero((parts > 0) | ~trained), np.flatnonzero((parts == 0) & trained)
    if not len(train):
        return LanguageModel([], np.zeros((BUCKETS, WIDTH)), np.zeros((WIDTH, 0)), np.zeros(0), 1.0, 0.0)
    embedding, weights, bias = _descend([rows[i] for i in train], wanted[train], len(languages))
    if not len(held):
        return LanguageModel(languages, embedding, weights, bias, 1.0, 0.0)
    logits = np.stack([shares @ embedding[at] for at, shares in (rows[i] for i in held)]) @ weights + bias
    truth = wanted[held]

    def loss(t: float) -> float:
        return -float(np.log(_softmax(logits / t)[np.arange(len(held)), truth] + 1e-12).mean())

    temperature = min((float(t) for t in np.geomspace(0.05, 5, 60)), key=loss)
    chances = _softmax(logits / temperature)
    right = chances.max(axis=1)[chances.argmax(axis=1) == truth]
    threshold = float(np.quantile(right, 1 - KEPT_SHARE)) if len(right) else 0.0
    return LanguageModel(languages, embedding, weights, bias, temperature, min(threshold, EVEN_GUESS))


def train_languages(docs: DataFrame, sample: int = SAMPLE, total: int = TOTAL) -> LanguageModel:
    """A model from rows with text and lang whose crc32(doc_id) mod 4 is not 2.

    At most about ``sample`` rows per language and ``total`` in all train it, whatever the number of languages; they are
    drawn by a hash of doc_id at a rate set by the counts of all rows. A fifth of them is set aside to calibrate the
    temperature and the rejection threshold. Without labelled rows every text is unknown.
    """
    labelled = docs.select("doc_id", "text", "lang").where(
        "text is not null and lang is not null and doc_id is not null"
    ).where(fold(F.col("doc_id"), 4) != 2)
    sizes = materialize(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("held")), scratch(docs.sparkSession, "languages"))
    most = max(1, min(sample, total // max(1, sizes.count())))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5))
    drawn = labelled.join(sizes, "lang").where(draw * F.col("held") < most).withColumn("part", part)
    names = ["lang", "part", "buckets", "counts"]
    table = drawn.select("lang", "part", "text").mapInArrow(
        _feature_batches, "lang string, part long, buckets binary, counts binary"
    ).toArrow()
    found = sorted(zip(*(table.column(n).to_pylist() for n in names), strict=True))
    del table  # the driver holds the features once
    return fit_languages([
        (lang, part, np.frombuffer(at, _BUCKET), np.frombuffer(counts, np.int32)) for lang, part, at, counts in found if len(at)
    ])


def _predictions(model: LanguageModel, batch: pa.RecordBatch) -> tuple[list[str], list[float]]:
    found = [model.predict(text.as_py()) for text in batch.column(batch.schema.get_field_index("text"))]
    return [f[0] for f in found], [f[1] for f in found]


def languages(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)`` per row of ``docs``.

    Only the text decides a prediction. Texts that are null or have no letter are ``und`` with score 0 and
    rejected; other texts get a learned language, and are rejected when its probability lies below the
    calibrated threshold. Null langs train nothing; null doc_ids are neither learned from nor held out
    (``held_out`` false). Repeated rows are predicted alike; other columns are ignored. One pass without
    a shuffle after training.
    """
    model = model or train_languages(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _predictions(model, batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    rejected = (F.col("lang_pred") == UNKNOWN) | (F.col("score") < model.threshold)
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", rejected.alias("rejected"))


def identified(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """The rows of ``docs`` that are not rejected, columns unchanged, whatever their names.

    Null texts, texts without a letter and those whose language stays below the threshold go; repeated rows stay or go
    together. Null ids and langs do not matter; an empty table gives an empty result.
    """
    model = model or train_languages(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _predictions(model, batch)
            kept = [n != UNKNOWN and s >= model.threshold for n, s in zip(names, scores, strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
