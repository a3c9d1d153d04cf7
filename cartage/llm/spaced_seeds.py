"""Benchmark decontamination by spaced seeds, from DataFrame functions only.

A seed hashes the tokens at the set positions of a fixed mask and ignores the others, so a substituted word
under an open position costs nothing. Seeds of benchmark items and of documents are joined; each hit fixes
how the item lies along the document, and along that line the tokens are compared. The mask of an item is
one that no placement of the substitutions SIMILARITY allows can escape, so seeds lose no match.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartage.session import materialize, scratch

# the pairs of neighbours (by offset) of three tokens in a row, within SPAN tokens
MASKS = ((0, 1),)
SPAN = 3
# set positions, the most telling first; an item takes the first that always hits, see mask_of
SEEDS = ((0, 1, 2, 4), tuple(sorted({o + k for o in MASKS[0] for k in (0, 1)})), (0, 1), (0,))
WINDOW = 20  # tokens of an item that must be found together (all of a shorter item)
SIMILARITY = 0.75  # least share of equal tokens in that window
BROADCAST_SEEDS = 200_000  # benchmark seeds up to this count are broadcast, about 10 MB
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; none for a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, _SPACE), lambda w: w != "")


@lru_cache
def mask_of(n: int) -> int:
    """Number in SEEDS of the first mask that hits every window of ``n`` tokens in which SIMILARITY of them are equal.

    Tries all placements of the unequal tokens. A single token hits whatever else does not.
    """
    unequal = int((1 - SIMILARITY) * n)
    for number, offsets in enumerate(SEEDS):
        starts = [sum(1 << (i + o) for o in offsets) for i in range(n - offsets[-1])]
        gaps = (sum(1 << at for at in places) for places in combinations(range(n), unequal))
        if all(any(not seed & gap for seed in starts) for gap in gaps):
            return number
    return len(SEEDS) - 1


def _hashed(rows: DataFrame) -> DataFrame:
    """``text`` as ``w``, a hash per token."""
    return rows.withColumn("w", F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w))).drop("text")


def _seeds(number: int) -> Column:
    """The seeds of a mask, one per token of ``w`` at which it starts; null where it sticks out at the end."""
    offsets = SEEDS[number]

    def seed(i: Column) -> Column:
        whole = F.xxhash64(*[F.get("w", i + o) for o in offsets], F.lit(number))
        return F.when(i < F.size("w") - offsets[-1], whole)

    return F.transform(F.sequence(F.lit(0), F.size("w") - 1), seed)


def _starts(rows: DataFrame, seeds: Column, name: str) -> DataFrame:
    """One row per seed and the position it starts at (one without a seed for a row that has none).

    The outer form keeps Catalyst from testing the array first, which would compute it twice.
    """
    out = rows.select("*", F.posexplode_outer(F.when(F.size("w") > 0, seeds)).alias("__at", "seed"))
    return out.withColumn(name, F.pmod(F.col("__at"), F.size("w"))).drop("__at")


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, n_equal, n_window)`` for every document that holds a passage of an item.

    A document matches an item if, with the item laid along it at some seed hit, some ``min(WINDOW, tokens of
    the item)`` neighbouring tokens of the item meet equal tokens of the document in SIMILARITY of the places;
    ``n_equal`` is the most found. Every such match is found, whatever the item's length; null or empty texts
    match nothing. Rows that repeat a doc_id or an item_id count as one; null ids match nothing. Other columns
    are ignored.

    Documents' words stay where they are until a seed matches; then only the stretch along the item moves.
    Repeated lines of a document, and passages many documents share, cost one row per hit. Seeds of
    the benchmark are broadcast while they are few by count, and joined by shuffling otherwise.
    """
    uri = scratch(docs.sparkSession, "seeds")
    items = benchmark.select(F.col("item_id"), "text").where("item_id is not null and text is not null")
    items = _hashed(items.distinct()).where(F.size("w") > 0)
    window = F.least(F.lit(WINDOW), F.size("w"))
    mask = F.get(F.array(*[F.lit(mask_of(n)) for n in range(1, WINDOW + 1)]), window - 1)
    items = materialize(items.withColumn("mask", mask), f"{uri}/words")
    masks = sorted(r["mask"] for r in items.select("mask").distinct().collect())  # those that the items need
    if not masks:
        masks = [0]
    own = F.coalesce(*[F.when(F.col("mask") == number, _seeds(number)) for number in masks])
    items = _starts(items, own, "item_at").drop("mask").withColumnRenamed("w", "item_w")
    items = materialize(items.where("seed is not null"), f"{uri}/items")
    wanted = items.select("seed", "item_id", "item_at", F.size("item_w").alias("n"))
    wanted = F.broadcast(wanted) if items.count() <= BROADCAST_SEEDS else wanted

    rows = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    hits = _starts(_hashed(rows), F.concat(*[_seeds(number) for number in masks]), "doc_at").join(wanted, "seed")
    # the document's tokens along the whole item; where the item sticks out there is nothing to compare
    line = F.col("doc_at") - F.col("item_at")
    first = F.greatest(line, F.lit(0))
    stretch = F.slice("w", first + 1, F.greatest(F.least(line + F.col("n"), F.size("w")) - first, F.lit(0)))
    lines = hits.select("doc_id", "item_id", line.alias("line"), stretch.alias("stretch")).distinct()
    lines = materialize(lines, f"{uri}/lines")

    whole = items.select("item_id", "item_w").distinct()
    compared = lines.join(whole, "item_id")
    skipped = F.greatest(-F.col("line"), F.lit(0))
    equal = F.transform(
        "item_w",
        lambda w, i: F.when((i >= skipped) & (F.get("stretch", i - skipped) == w), 1).otherwise(0),
    )
    compared = compared.withColumn("equal", equal).withColumn("n_window", F.least(F.lit(WINDOW), F.size("item_w")))
    totals = F.transform(
        F.sequence(F.lit(1), F.size("equal") - F.col("n_window") + 1),
        lambda i: F.aggregate(F.slice("equal", i, F.col("n_window")), F.lit(0), lambda a, b: a + b),
    )
    best = compared.select("doc_id", "item_id", "n_window", F.array_max(totals).alias("n_equal")).groupBy("doc_id", "item_id")
    best = best.agg(F.max("n_equal").alias("n_equal"), F.max("n_window").alias("n_window"))
    return best.where(F.col("n_equal") >= SIMILARITY * F.col("n_window"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of ``benchmark``; rows without doc_id stay."""
    held = contaminations(docs, benchmark).select("doc_id").distinct()
    # always by hash: the ids grow with the documents, so broadcasting them would not last
    return docs.join(held.hint("merge"), "doc_id", "left_anti").select(docs.columns)
