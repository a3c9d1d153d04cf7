"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

P(word | context) = P(class | context) * P(word | class, context). Frequent words sit in word classes whose
members a second softmax tells apart; all other words sit in tail classes by their last two bytes, within
which smoothed counts over the whole corpus decide. Features are hashed: the previous word, the one before,
a skip over two, and the previous pair. Distributed gradient steps train the weights: per round every
learner starts from the same weights, descends over its share of the examples, and the changes are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartage.llm.sampling import fold
from cartage.llm.words import chunks, hashed_words, mix
from cartage.session import materialize, scratch

WORD_CLASSES, PER_CLASS, TAILS = 31, 32, 32
EXPLICIT = WORD_CLASSES * PER_CLASS - 1  # frequent words with a weight vector; the text's end takes the last place
CLASSES = WORD_CLASSES + TAILS
DIRECT = 1 << 18  # at most so many frequent words have counts that travel with the tasks (4 MB); the rest is joined
BUCKETS, BUCKETS_2 = 1 << 13, 1 << 10
SMOOTH = 0.1
ROUNDS = 3  # every text is learned from in one of them, at all its positions
PER_LEARNER = 500_000  # examples that a learner has in a round at least, about
FANIN = 32  # changes that one task adds up; those of more learners are added in a tree
BATCH, RATE = 2048, 0.3
BLOCKS = 16
ONE_BY_ONE = 8  # how often a weight row is named in a batch before the rest of its changes is added per row

_U = np.uint64
_BEGIN = _U(0x5EED5EED5EED5EED)
_SALT = mix(np.arange(1, 9, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_SLOTS = 1 << 22


def _tails(texts: list[bytes], n: int) -> np.ndarray:
    """Per word of ``texts`` its tail class, by its last two bytes."""
    data = np.frombuffer(b"  " + b" ".join(texts).lower() + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.flatnonzero(~space[:-1] & space[1:])
    before = np.where(space[last - 1], 0, data[last - 1]).astype(np.uint64)
    assert len(last) == n
    return (mix(data[last].astype(np.uint64) * _U(257) + before) % _U(TAILS)).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the training rows with their counts, combined within the task up to a bounded size."""
    keys, tails, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def combined(k, t, c):
        unique, first, inverse = np.unique(k, return_index=True, return_inverse=True)
        return unique, t[first], np.bincount(inverse, weights=c, minlength=len(unique)).astype(np.int64)

    def rows(k, t, c):
        return pa.RecordBatch.from_arrays(
            [pa.array(k.view(np.int64)), pa.array(t.astype(np.int32)), pa.array(c)], names=["word", "tail", "n"]
        )

    for batch in batches:
        for _, _, raw in chunks(batch.column("text").to_pylist()):
            words, _ = hashed_words(raw)
            k, t, c = combined(words, _tails(raw, len(words)), np.ones(len(words)))
            keys, tails, counts = combined(np.concatenate([keys, k]), np.concatenate([tails, t]), np.concatenate([counts, c]))
            if len(keys) > 400_000:
                yield rows(keys, tails, counts)
                keys, tails, counts = keys[:0], tails[:0], counts[:0]
    yield rows(keys, tails, counts)


class Vocabulary:
    """Counts that travel with the tasks: the most frequent words, and totals over all words."""

    def __init__(self, direct: pa.Table, texts: int, words: int, distinct: int, tail_rows: list):
        self.words = direct.column("word").to_numpy().view(np.uint64)
        self.counts = direct.column("n").to_numpy()
        self.total = words + texts
        self.distinct = distinct + (texts > 0)
        self.ends = texts
        # the most frequent words that find() will find; all others are tail words
        kept = np.sort(np.unique(self.words & _U(_SLOTS - 1), return_index=True)[1])[:EXPLICIT]
        self.explicit = np.full(len(self.words), -1, np.int64)
        self.explicit[kept] = np.arange(len(kept))
        tail_n, tail_v = np.zeros(TAILS), np.zeros(TAILS)
        for row in tail_rows:
            tail_n[row["tail"]], tail_v[row["tail"]] = row["n"], row["v"]
        tails = direct.column("tail").to_numpy()[kept]
        tail_n -= np.bincount(tails, weights=self.counts[kept], minlength=TAILS)
        tail_v -= np.bincount(tails, minlength=TAILS)
        self.tail_norm = np.log10(tail_n + SMOOTH * (tail_v + 1))
        self.tail_mass = tail_n + SMOOTH * (tail_v + 1)
        self.norm = float(np.log10(self.total + SMOOTH * (self.distinct + 1)))
        self._slots = None

    def find(self, words: np.ndarray) -> np.ndarray:
        """Index of each word among those that travel, else -1. Words that lose a slot to another are joined like rare ones."""
        if self._slots is None:
            slots = np.full(_SLOTS, -1, np.int32)
            at = (self.words & _U(_SLOTS - 1)).astype(np.int64)
            slots[at[::-1]] = np.arange(len(at) - 1, -1, -1)  # the more frequent one keeps the slot
            self._slots = slots
        if not len(self.words):
            return np.full(len(words), -1, np.int64)
        found = self._slots[(words & _U(_SLOTS - 1)).astype(np.int64)].astype(np.int64)
        found[self.words[found] != words] = -1
        return found

    def __getstate__(self):
        return self.__dict__ | {"_slots": None}

    def explicit_of(self, found: np.ndarray) -> np.ndarray:
        """Number among the explicit words, else -1."""
        return np.where(found >= 0, self.explicit[found] if len(self.explicit) else -1, -1)

    def first_weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Biases from the counts, no other weight: the model starts as a class-based unigram model."""
        first, second = np.zeros((BUCKETS, CLASSES), np.float32), np.zeros((BUCKETS_2, WORD_CLASSES, PER_CLASS), np.float32)
        mass = np.full((WORD_CLASSES, PER_CLASS), SMOOTH)
        held = np.flatnonzero(self.explicit >= 0)
        mass[self.explicit[held] % WORD_CLASSES, self.explicit[held] // WORD_CLASSES] += self.counts[held]
        mass[EXPLICIT % WORD_CLASSES, EXPLICIT // WORD_CLASSES] += self.ends
        first[0, :WORD_CLASSES] = np.log(mass.sum(axis=1))
        first[0, WORD_CLASSES:] = np.log(self.tail_mass)
        first[0] -= first[0].max()
        second[0] = np.log(mass)
        return first, second


def _tokens(raw: list[bytes], vocabulary: Vocabulary):
    """Tokens of a chunk, an end after every text: hashes, class, place in the class (-1 in a tail), index among
    the travelling words (-2 for an end), text number, features of both softmaxes."""
    words, offsets = hashed_words(raw)
    sizes = np.diff(offsets)
    ends = offsets[1:] + np.arange(len(raw))
    total = len(words) + len(raw)
    inner = np.ones(total, bool)
    inner[ends] = False
    hashes = np.full(total, _BEGIN, np.uint64)
    hashes[inner] = words
    text = np.repeat(np.arange(len(raw)), sizes + 1)
    starts = ends - sizes
    found = np.full(total, -2, np.int64)
    found[inner] = vocabulary.find(words)
    kind, place = np.empty(total, np.int64), np.full(total, -1, np.int64)
    explicit = vocabulary.explicit_of(found[inner])
    tails = _tails(raw, len(words))
    kind[inner] = np.where(explicit >= 0, explicit % WORD_CLASSES, WORD_CLASSES + tails)
    place[inner] = np.where(explicit >= 0, explicit // WORD_CLASSES, -1)
    kind[~inner], place[~inner] = EXPLICIT % WORD_CLASSES, EXPLICIT // WORD_CLASSES
    nth = np.arange(total) - starts[text]

    def back(k: int) -> np.ndarray:
        moved = np.full(total, _BEGIN, np.uint64)
        moved[k:] = hashes[: total - k]
        moved[nth < k] = _BEGIN
        return moved

    one, two, three = back(1), back(2), back(3)
    # bucket 0 is the bias
    hashed = [mix(one + _SALT[0]), mix(two + _SALT[1]), mix(three + _SALT[2]), mix(one * _SALT[3] + two)]
    # a column's values lie side by side, as takes and sorts want them
    features = np.zeros((5, total), np.int64)
    features_2 = np.zeros((3, total), np.int64)
    for column, h in enumerate(hashed, 1):
        features[column] = h % _U(BUCKETS - 1) + _U(1)
    for column, h in enumerate(hashed[:2], 1):
        features_2[column] = mix(h) % _U(BUCKETS_2 - 1) + _U(1)
    return hashes, kind, place, found, text, nth, features.T, features_2.T


def _examples(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per chunk of texts every position as an example, in an order by hash: class, place, features of both softmaxes."""
    for batch in batches:
        for _, _, raw in chunks(batch.column("text").to_pylist()):
            hashes, kind, place, _, _, nth, features, features_2 = _tokens(raw, vocabulary)
            draw = mix(hashes * _SALT[4] + features[:, 4].astype(np.uint64) + nth.astype(np.uint64) * _SALT[5])
            order = np.argsort(draw)
            yield kind[order], place[order], np.take(features.T, order, axis=1).T, np.take(features_2.T, order, axis=1).T


def _logits(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per example the sum of the weight rows its features name."""
    out = np.take(weights, rows[:, 0], axis=0)
    for column in range(1, rows.shape[1]):
        out += np.take(weights, rows[:, column], axis=0)
    return out


def _class_logits(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The same where the first feature is the bias of every example, row 0."""
    out = _logits(weights, features[:, 1:])
    out += weights[0]
    return out


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """Per row the exponentials, their sum, and what was taken off first: its maximum, or nothing where no row needs it."""
    ones = np.ones(logits.shape[1], logits.dtype)
    with np.errstate(over="ignore"):
        chances = np.exp(logits)
        sums = chances @ ones
    if sums.min(initial=1) > 1e-20 and sums.max(initial=1) < 1e20:
        return chances, sums, 0.0
    top = logits.max(axis=1)
    chances = np.exp(logits - top[:, None])
    return chances, chances @ ones, top


def _softmax(logits: np.ndarray) -> np.ndarray:
    chances, sums, _ = _exponentials(logits)
    chances *= (1 / sums)[:, None]
    return chances


def _log_chance(logits: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Per row of ``logits`` the log of the softmax at the place ``of`` names."""
    _, sums, top = _exponentials(logits)
    return logits[np.arange(len(of)), of] - top - np.log(sums)


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _scatter(weights: np.ndarray, seen: np.ndarray, features: np.ndarray, gradient: np.ndarray) -> None:
    """One AdaGrad step on the rows named by each example's features, repeated rows summed; ``seen`` holds a sum
    of squares per row."""
    named = features.T.ravel().astype(np.int16)  # all rows fit, and 16 bits are sorted by radix
    order = np.argsort(named, kind="stable")
    named = named[order]
    at = np.tile(np.arange(len(gradient)), features.shape[1])[order]
    new = np.ones(len(named) + 1, bool)
    np.not_equal(named[1:], named[:-1], out=new[1:-1])
    bounds = np.flatnonzero(new)
    first, sizes = bounds[:-1], bounds[1:] - bounds[:-1]
    # rows named most often come first: those named more than n times are then a stretch at the front
    level = np.minimum(sizes, ONE_BY_ONE + 1).astype(np.int8)
    by = np.argsort(-level, kind="stable")
    first, sizes = first[by], sizes[by]
    rows = named[first].astype(np.int64)
    more = len(rows) - np.cumsum(np.bincount(level, minlength=ONE_BY_ONE + 1))
    # most rows are named a few times only: add what they have first, second... together, and what is left per row
    summed = np.take(gradient, at[first], axis=0)
    for nth in range(1, ONE_BY_ONE):
        if not more[nth]:
            break
        summed[: more[nth]] += np.take(gradient, at[first[: more[nth]] + nth], axis=0)
    if often := more[ONE_BY_ONE]:
        left = sizes[:often] - ONE_BY_ONE
        begins = np.cumsum(left) - left
        places = np.arange(left.sum()) + np.repeat(first[:often] + ONE_BY_ONE - begins, left)
        summed[:often] += np.add.reduceat(np.take(gradient, at[places], axis=0), begins, axis=0)
    squares = seen[rows] + (summed * summed) @ np.ones(summed.shape[1], summed.dtype) / summed.shape[1]
    seen[rows] = squares
    summed *= (RATE / np.sqrt(squares + 1.0)).astype(np.float32)[:, None]
    weights[rows] = np.take(weights, rows, axis=0) - summed


def _scatter_classes(weights: np.ndarray, seen: np.ndarray, features: np.ndarray, gradient: np.ndarray) -> None:
    """The same where the first feature is the bias of every example: its row takes the sum of all at once."""
    _scatter(weights, seen, features[:, 1:], gradient)
    summed = np.ones(len(gradient), gradient.dtype) @ gradient
    seen[0] += (summed * summed).mean()
    weights[0] -= RATE * summed / np.sqrt(seen[0] + 1.0)


def _learn(vocabulary: Vocabulary, weights: tuple[np.ndarray, np.ndarray]):
    """Local descent over all positions of a partition's texts; yields the change of each block of rows and which rows changed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = weights[0].copy(), weights[1].copy().reshape(BUCKETS_2 * WORD_CLASSES, PER_CLASS)
        seen, seen_2 = np.zeros(len(first)), np.zeros(len(second))
        steps = 0
        for kinds, places, all_features, all_features_2 in _examples(vocabulary, batches):
            for at in range(0, len(kinds), BATCH):
                steps += 1
                kind, place, features = (x[at : at + BATCH] for x in (kinds, places, all_features))
                n = len(kind)
                error = _softmax(_class_logits(first, features))
                error[np.arange(n), kind] -= 1
                _scatter_classes(first, seen, features, error)
                named = np.flatnonzero(place >= 0)
                if len(named):
                    rows = all_features_2[at + named] * WORD_CLASSES + kind[named][:, None]
                    error = _softmax(_logits(second, rows))
                    error[np.arange(len(named)), place[named]] -= 1
                    _scatter(second, seen_2, rows, error)
        if not steps:
            return
        second_before = weights[1].reshape(second.shape)
        out: dict[str, list] = {"block": [], "change": [], "touched": []}
        for offset, after, before, used in ((0, first, weights[0], seen), (BLOCKS, second, second_before, seen_2)):
            for block, rows in enumerate(np.array_split(np.arange(len(after)), BLOCKS)):
                out["block"].append(offset + block)
                out["change"].append((after[rows] - before[rows]).astype(np.float32).tobytes())
                out["touched"].append((used[rows] > 0).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_pydict(out, pa.schema([("block", pa.int32()), ("change", pa.binary()), ("touched", pa.binary())]))

    return run


_CHANGES = "block int, learner long, change binary, touched binary"


def _added(changes):
    """One row of sums for all changes of a block; ``touched`` counts the learners that changed a row."""
    sums = [sum(np.frombuffer(c, np.float32) for c in changes[name]).astype(np.float32).tobytes() for name in ("change", "touched")]
    return changes.iloc[:1][["block", "learner"]].assign(change=[sums[0]], touched=[sums[1]])


def train_weights(train: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Weights of both softmaxes after one pass over all positions of ``train`` (doc_id, text) in ROUNDS rounds.

    The texts stay where they are read: a learner takes a round's share of some partitions of the input and makes the
    examples itself. Learners grow with the input. Their changes, 6 MB each at most, are added in a tree of FANIN; the
    driver holds the weights and, per round, one sum of the same size.
    """
    first, second = vocabulary.first_weights()
    learners = int(max(4, vocabulary.total // (ROUNDS * PER_LEARNER) + 1))
    draw = F.xxhash64("doc_id", "text")
    for number in range(ROUNDS):
        share = train.where(F.pmod(draw, F.lit(ROUNDS)) == number).select("text").coalesce(learners)
        changes = share.mapInArrow(_learn(vocabulary, (first, second)), "block int, change binary, touched binary")
        changes = changes.select("block", F.spark_partition_id().cast("long").alias("learner"), "change", "touched")
        left = learners
        while left > FANIN:
            changes = changes.withColumn("learner", F.floor(F.col("learner") / FANIN))
            changes = changes.groupBy("block", "learner").applyInPandas(_added, _CHANGES)
            left = -(-left // FANIN)
        rows = changes.groupBy("block").applyInPandas(_added, _CHANGES).collect()
        flat = second.reshape(-1, PER_CLASS)
        places = [*np.array_split(np.arange(len(first)), BLOCKS), *np.array_split(np.arange(len(flat)), BLOCKS)]
        for row in rows:
            target = first if row["block"] < BLOCKS else flat
            at = places[row["block"]]
            times = np.maximum(np.frombuffer(row["touched"], np.float32), 1)[:, None]
            target[at] += np.frombuffer(row["change"], np.float32).reshape(len(at), -1) / times
    return first, second


def _score_batches(vocabulary: Vocabulary, weights: tuple[np.ndarray, np.ndarray]):
    """Per text what can be said at once, as a row without a word; per word whose count must be joined a row with it."""
    first, second = weights[0], weights[1].reshape(-1, PER_CLASS)
    log_counts = np.log10(vocabulary.counts + SMOOTH) if len(vocabulary.counts) else np.zeros(1)
    end_base = np.log10(vocabulary.ends + SMOOTH) - vocabulary.norm
    ten = np.log(10)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, ids = batch.column("uid").to_numpy(), batch.column("doc_id")
            for begin, _, raw in chunks(batch.column("text").to_pylist()):
                hashes, kind, place, found, text, _, features, features_2 = _tokens(raw, vocabulary)
                total = len(hashes)
                score = np.empty(total)
                for at in range(0, total, 4096):
                    here = slice(at, min(total, at + 4096))
                    score[here] = _log_chance(_class_logits(first, features[here]), kind[here]) / ten
                named = np.flatnonzero(place >= 0)
                for at in range(0, len(named), 4096):
                    here = named[at : at + 4096]
                    rows = features_2[here] * WORD_CLASSES + kind[here][:, None]
                    score[here] += _log_chance(_logits(second, rows), place[here]) / ten
                tail = place < 0
                score[tail] -= vocabulary.tail_norm[kind[tail] - WORD_CLASSES]
                direct = found >= 0
                logs = np.where(direct, log_counts[np.maximum(found, 0)], 0.0)
                score[tail] += logs[tail]
                base = logs - vocabulary.norm
                base[found == -2] = end_base
                known = direct | ((found == -2) & (vocabulary.ends > 0))
                n = len(raw)
                where = uids[begin : begin + n]
                rest = np.flatnonzero(found == -1)
                order = rest[np.lexsort((hashes[rest], text[rest]))]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(order)))
                rare = order[at]
                none = pa.nulls(len(rare), pa.int64())
                own_ids = ids.slice(begin, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([where, where[text[rare]]])),
                        pa.concat_arrays([own_ids, pa.nulls(len(rare), own_ids.type)]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(hashes[rare].view(np.int64))]),
                        pa.concat_arrays([pa.array(np.bincount(text, minlength=n)), pa.array(times.astype(np.int64))]),
                        pa.concat_arrays([pa.array(np.bincount(text[known], minlength=n)), none]),
                        pa.concat_arrays([pa.array(np.bincount(text, weights=base, minlength=n)), none.cast(pa.float64())]),
                        pa.concat_arrays([pa.array(np.bincount(text, weights=score, minlength=n)), none.cast(pa.float64())]),
                    ],
                    names=["uid", "doc_id", "word", "n", "n_known", "base", "score"],
                )

    return run


def training(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, 10) != 0, F.lit(False))


def _least_count(counts: DataFrame) -> int:
    """The smallest power of two that at most DIRECT words reach; found from how many words each power has."""
    power = F.floor(F.log2("n")).cast("int")
    words = {r["power"]: r["words"] for r in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("words")).collect()}
    least = max(words, default=0) + 1
    while least > 0 and sum(n for p, n in words.items() if p >= least - 1) <= DIRECT:
        least -= 1
    return 1 << least


def lm_scores(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Tokens are words and one end per text; a null text is empty and has the end only. Learns from rows whose
    crc32(doc_id) mod 10 is not 0; a null doc_id neither trains nor is held out. ``base_score`` is the
    smoothed unigram log10 probability, ``score`` that of the model. Without training rows both spread all
    mass over unknown words. Repeated rows are scored alike; other columns are ignored.

    Counts cover every token of the training rows, and so do the gradient steps. Words beyond the DIRECT most frequent are joined with
    their counts by hash of the word, so no task needs the whole vocabulary.
    """
    uri = scratch(docs.sparkSession, "maxent")
    train = docs.where(training(F.col("doc_id"))).select("doc_id", "text")
    counts = train.select("text").mapInArrow(_count_batches, "word long, tail int, n long")
    counts = materialize(counts.groupBy("word").agg(F.max("tail").alias("tail"), F.sum("n").alias("n")), f"{uri}/counts")
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    direct = counts.where(F.col("n") >= _least_count(counts)).select("word", "tail", "n").toArrow()
    direct = direct.sort_by([("n", "descending"), ("word", "ascending")])
    by_tail = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # TAILS rows
    vocabulary = Vocabulary(direct, train.count(), totals["n"] or 0, totals["v"], by_tail)
    weights = train_weights(train, vocabulary)

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    said = rows.mapInArrow(
        _score_batches(vocabulary, weights),
        f"uid long, doc_id {kind}, word long, n long, n_known long, base double, score double",
    )
    said = materialize(said, f"{uri}/said")
    rare = said.where("word is not null").join(counts.select("word", F.col("n").alias("c")), "word", "left")
    log_count = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)
    rare = rare.select(
        "uid", "doc_id", F.lit(0).cast("long").alias("n"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"),
        log_count.alias("base"), log_count.alias("score"),
    )
    whole = said.where("word is null").select("uid", "doc_id", "n", "n_known", "base", "score").unionByName(rare)
    summed = whole.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    )
    held = F.coalesce(fold(F.col("doc_id"), 10) == 0, F.lit(False))
    return summed.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known",
        F.lit(vocabulary.total).cast("long").alias("train_tokens"), "base_score", "score",
    )
