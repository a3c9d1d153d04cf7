"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions.

The key of a record is (crc32 of its text, doc_id), so copies of a text lie next to each other and a hot
text is cut by doc_id. Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartage.session import materialize, scratch

RANGES = 1024  # ranges aimed at; each is sorted by one task, on keys and sizes only
PER_RANGE = 8  # expected samples behind each boundary
SLOTS = 4096  # a boundary is found by its leading bits first
_TOP = 1 << 32
_LARGEST = (1 << 63) - 1

_ORDER = ("text_crc32", "tie", "size")


def _before(crc: Column, tie: Column, other_crc: Column, other_tie: Column) -> Column:
    return (crc < other_crc) | ((crc == other_crc) & (tie < other_tie))


def _sampled(keys: DataFrame, rate: Column) -> DataFrame:
    """Poisson sampling by a hash of the key: a record is drawn with probability size * rate, at most 1."""
    draw = F.pmod(F.xxhash64("text_crc32", "tie", F.lit("splitter")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return keys.where(draw < F.col("size") * rate)


def _boundaries(sample: DataFrame, every: int) -> DataFrame:
    """Every ``every``-th key of a sample whose expected size is RANGES * PER_RANGE at most."""
    order = Window.orderBy("text_crc32", "tie")
    ranked = sample.select("text_crc32", "tie").distinct().withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") % every == 0).select("text_crc32", "tie")


def _lookup(boundaries: DataFrame) -> DataFrame:
    """Per leading bits: how many boundaries lie below them, and the boundaries within, in order."""
    width = _TOP // SLOTS
    spark = boundaries.sparkSession
    slots = spark.range(0, SLOTS, 1, 1).select(F.col("id").cast("int").alias("lead"))
    held = boundaries.groupBy(F.floor(F.col("text_crc32") / width).cast("int").alias("lead")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("text_crc32").alias("crc"), "tie"))).alias("within")
    )
    filled = slots.join(F.broadcast(held), "lead", "left")
    below = F.coalesce(F.sum(F.size("within")).over(Window.orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return filled.withColumn("within", F.coalesce("within", F.array().cast("array<struct<crc:bigint,tie:bigint>>"))).withColumn(
        "below", below.cast("int")
    )


def _ranged(keys: DataFrame, lookup: DataFrame) -> DataFrame:
    """``keys`` with the number of its range: boundaries not above the key. The lookup has SLOTS rows."""
    lead = F.floor(F.col("text_crc32") / (_TOP // SLOTS)).cast("int")
    passed = F.filter("within", lambda b: ~_before(F.col("text_crc32"), F.col("tie"), b["crc"], b["tie"]))
    joined = keys.withColumn("lead", lead).join(F.broadcast(lookup), "lead")
    return joined.withColumn("range", F.col("below") + F.size(passed)).drop("lead", "within", "below")


def range_numbers(keys: DataFrame, uri: str, total: int, rounds: int = 4) -> DataFrame:
    """``keys`` with ``range``: order-preserving ranges of about total / RANGES bytes.

    Ranges found to hold more than twice their share are sampled again at a higher rate and cut at the new
    boundaries; a range made of one key cannot be cut further and stays whole.
    """
    share = max(1.0, total / RANGES)
    sample = _sampled(keys, F.lit(PER_RANGE / share))
    boundaries = materialize(_boundaries(sample, PER_RANGE), f"{uri}/boundaries-0")
    for step in range(1, rounds + 1):
        lookup = materialize(_lookup(boundaries), f"{uri}/lookup-{step}")
        ranged = _ranged(keys, lookup)
        held = ranged.groupBy("range").agg(
            F.sum("size").alias("held"), F.min(F.struct("text_crc32", "tie")).alias("first"), F.max(F.struct("text_crc32", "tie")).alias("last")
        )
        full = materialize(
            held.where((F.col("held") > 2 * share) & (F.col("first") != F.col("last"))).select("range", "held"), f"{uri}/full-{step}"
        )
        if step == rounds or full.isEmpty():
            return ranged
        # every range aims at pieces of one share: PER_RANGE samples for each
        again = _sampled(ranged.join(F.broadcast(full), "range"), F.lit(4 * PER_RANGE / share))
        more = _boundaries(again, 4 * PER_RANGE)
        if step > 1:  # a boundary for each key drawn, where the coarse ones did not suffice
            more = again.select("text_crc32", "tie").distinct()
        boundaries = materialize(boundaries.unionByName(more).distinct(), f"{uri}/boundaries-{step}")
    return ranged


def shards(docs: DataFrame, count: int = 16) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row of ``docs``.

    ``law`` is ``bytes``: a record whose middle is byte b of all T, in key order, goes to shard b * count / T,
    so a shard's bytes differ from T / count by at most half of the records at its two ends. Slots
    number a shard's records in key order, without gaps. Size is the UTF-8 bytes of the text plus 1; a null
    text has size 1 and crc 0, as the empty text. Null doc_ids sort first. Rows that repeat key and size
    are interchangeable and get neighbouring slots. Other columns are ignored; an empty table gives an
    empty result.

    Texts are read once, for size and checksum; only those move afterwards.
    """
    uri = scratch(docs.sparkSession, "shards")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keys = materialize(
        docs.select(
            F.col("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(-_LARGEST - 1)).alias("tie"),
        ),
        f"{uri}/keys",
    )
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranged = materialize(range_numbers(keys, uri, total), f"{uri}/ranged")
    # one row per range, about RANGES of them
    sums = ranged.groupBy("range").agg(F.sum("size").alias("held"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(
        sums.select(
            "range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        ),
        f"{uri}/bases",
    )
    inside = Window.partitionBy("range").orderBy(*_ORDER)
    running = ranged.withColumn("through", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    running = running.withColumn("nth", F.row_number().over(inside)).join(F.broadcast(bases), "range")
    start = F.col("bytes_before") + F.col("through") - F.col("size")
    shard = F.expr(f"cast(((2 * cast(start as decimal(30,0)) + size) * {count}) div {max(1, 2 * total)} as int)")
    placed = materialize(
        running.withColumn("start", start).select(
            "doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("nth") - 1).alias("position")
        ),
        f"{uri}/placed",
    )
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))  # ``count`` rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("position") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
