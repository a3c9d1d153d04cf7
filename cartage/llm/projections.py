"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Unit vectors are projected on random lines. Cells of a few quantized projections, in several tables, bring
vectors together; within a cell every vector opens a window around its own value on each of many sorted
projections and counts, per other vector, the windows that hold it. Pairs that reach a count calibrated for
recall are verified by their cosine in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartage.llm.components import components
from cartage.session import materialize, scratch

COSINE = 0.98
MISS = 0.002  # chance that a pair at COSINE shares no cell
COUNT_MISS = 0.001  # chance that such a pair misses the collision count
LINES = 32  # projections whose collisions are counted
CELL_WIDTH = 1.6  # of the quantized projections
AIM = 64  # vectors of a cell, about
BLOCK = 128  # vectors of a cell on either side of one comparison

_DISTANCE = math.sqrt(2 - 2 * COSINE)  # of two unit vectors at COSINE; a projection's difference has this deviation
WINDOW = 2 * _DISTANCE


def _below(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def same_cell(distance: float) -> float:
    """Chance that two points at a distance fall in one cell of one projection, for a random offset."""
    c = CELL_WIDTH / distance
    return 1 - 2 * _below(-c) - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def least_count(lines: int = LINES) -> int:
    """The largest count that a pair at COSINE reaches with a chance of 1 - COUNT_MISS."""
    hit = 1 - 2 * _below(-WINDOW / _DISTANCE)
    tail, count = 0.0, lines + 1
    while tail < 1 - COUNT_MISS:
        count -= 1
        tail += math.comb(lines, count) * hit**count * (1 - hit) ** (lines - count)
    return count


def tables_for(largest: int) -> tuple[int, int]:
    """Projections per cell, and tables, for a label of ``largest`` vectors."""
    apart = same_cell(math.sqrt(2.0))
    per_cell = max(1, math.ceil(math.log(max(1.0, largest / AIM)) / -math.log(apart)))
    together = same_cell(_DISTANCE) ** per_cell
    return per_cell, max(1, math.ceil(math.log(MISS) / math.log(1 - together)))


def _directions(dimensions: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7919 * dimensions + number)
    return random.normal(size=(dimensions, number)), random.uniform(0, CELL_WIDTH, number)


def _unit(raw: np.ndarray) -> np.ndarray:
    vectors = raw.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _cell_numbers(vectors: np.ndarray, per_cell: int, tables: int) -> np.ndarray:
    """Cells of unit vectors, one row per vector, one column per table; each table has lines of its own."""
    lines, offsets = _directions(vectors.shape[1], per_cell * tables)
    steps = np.floor((vectors @ lines + offsets) / CELL_WIDTH).astype(np.int64).astype(np.uint64)
    weights = np.random.default_rng(31).integers(1, 1 << 63, per_cell, dtype=np.uint64) | np.uint64(1)
    mixed = (steps.reshape(len(vectors), tables, per_cell) * weights).sum(axis=2, dtype=np.uint64)
    mixed = (mixed + np.arange(1, tables + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def _assign(per_cell: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list = [None] * batch.num_rows
            raw = [np.array(v, np.float32) for v in batch.column("embedding").to_pylist()]
            for size in {len(v) for v in raw}:
                at = [i for i, v in enumerate(raw) if len(v) == size]
                for i, row in zip(at, _cell_numbers(_unit(np.stack([raw[i] for i in at])), per_cell, tables), strict=True):
                    cells[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("label"), pa.array([v.tobytes() for v in raw], pa.binary()), pa.array(cells, pa.list_(pa.int64()))],
                names=["rep", "label", "vector", "cells"],
            )

    return run


def collisions(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Per pair the number of projections on which ``right`` lies in the window centred on ``left``."""
    counts = np.zeros((len(left), len(right)), np.int16)
    for line in range(left.shape[1]):
        order = np.argsort(right[:, line], kind="stable")
        values = right[order, line]
        low = np.searchsorted(values, left[:, line] - WINDOW, "left")
        high = np.searchsorted(values, left[:, line] + WINDOW, "right")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        counts += (rank >= low[:, None]) & (rank < high[:, None])
    return counts


def _compare(per_cell: int, tables: int, needed: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(key, reps: list, sides: list, raw: list) -> Iterator[pa.RecordBatch]:
        ids, sides = np.array(reps), np.array(sides)
        vectors = _unit(np.stack([np.frombuffer(v, np.float32) for v in raw]))
        first = np.flatnonzero(sides == 0)
        second = np.flatnonzero(sides == 1) if key[3] != key[4] else first
        if not len(first) or not len(second):
            return
        lines, _ = _directions(vectors.shape[1], per_cell * tables + LINES)
        spots = vectors @ lines[:, -LINES:]
        at_first, at_second = np.nonzero(collisions(spots[first], spots[second]) >= needed)
        i, j = first[at_first], second[at_second]
        if key[3] == key[4]:
            i, j = i[i < j], j[i < j]
        close = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= COSINE
        i, j = i[close], j[close]
        # a pair is told by the first table that brings it together
        cells = _cell_numbers(vectors, per_cell, tables)
        told = (cells[i] == cells[j]).argmax(axis=1) == key[2] if len(i) else np.zeros(0, bool)
        i, j = i[told], j[told]
        if len(i):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], schema=schema
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reps, sides, raw = None, [], [], []
        for batch in batches:
            rows = batch.to_pydict()
            for i in range(batch.num_rows):
                now = tuple(rows[c][i] for c in ("label", "cell", "nth", "p", "q", "size"))
                if now != key:
                    if key is not None:
                        yield from pairs(key, reps, sides, raw)
                    key, reps, sides, raw = now, [], [], []
                reps.append(rows["rep"][i]), sides.append(rows["side"][i]), raw.append(rows["vector"][i])
        if key is not None:
            yield from pairs(key, reps, sides, raw)

    return run


def comparable(embedding: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def linked_pairs(classes: DataFrame, uri: str) -> DataFrame:
    """``(a, b)`` with a < b for classes ``(rep, label, embedding)`` of one label whose cosine reaches COSINE."""
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    per_cell, tables = tables_for(largest)
    placed = classes.select("rep", "label", "embedding").mapInArrow(
        _assign(per_cell, tables), "rep long, label int, vector binary, cells array<long>"
    )
    placed = materialize(placed, f"{uri}/placed")
    cell = ("label", "nth", "cell", "size")
    spread = placed.select("rep", "label", F.octet_length("vector").alias("size"), "vector", F.posexplode("cells").alias("nth", "cell"))
    held = materialize(spread.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"{uri}/cells")
    rows = spread.join(held, list(cell)).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        *cell, F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "vector",
    )
    dealt = rows.repartition(*cell, "p", "q").sortWithinPartitions(*cell, "p", "q")
    return dealt.mapInArrow(_compare(per_cell, tables, least_count()), "a long, b long")


def embedding_groups(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``embeddings``.

    Vectors link when their labels are equal and their cosine is COSINE or more; vectors of different
    length, null labels, and vectors that are null, empty, zero or hold null or non-finite components link with
    nothing. Equal vectors of a label form a class first and are never paired; a row's links count all rows of
    its class but itself and all rows of linked classes, repeated rows included. A null vec_id is counted by
    others, its own component is its class's; kept is then true. Other columns are ignored.

    No bound on a cell: larger ones are compared block by block.
    """
    uri = scratch(embeddings.sparkSession, "projections")
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    )
    able = rows.where(comparable(F.col("embedding")) & F.col("label").isNotNull())
    classes = able.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("members"))
    classes = materialize(classes, f"{uri}/classes")
    pairs = materialize(linked_pairs(classes.where("rep is not null"), uri), f"{uri}/pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("rep").alias("b"), "members")
    linked = both.join(sizes, "b").groupBy("a").agg(F.sum("members").alias("others"))
    found = components(pairs)
    named = classes.join(linked, classes["rep"] == linked["a"], "left").join(found, classes["rep"] == found["node"], "left")
    named = materialize(
        named.select(
            "label", "embedding", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
            F.coalesce("component", "rep").alias("of"),
        ),
        f"{uri}/named",
    )
    out = rows.join(named, ["label", "embedding"], "left")
    component = F.coalesce("of", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
