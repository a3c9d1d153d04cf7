"""Near-duplicate documents by one-permutation hashing.

One hash per distinct five-word shingle falls into one of ``BINS`` bins, the smallest hash of a bin is its
value, and empty bins borrow from bins drawn by a hash of their own number (optimal densification). Runs
of ``ROWS`` bins are banded buckets. Two documents with similarity s share a bucket with probability
1 - (1 - s**ROWS)**BANDS, 0.99998 at 0.75.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartage.llm.components import components
from cartage.llm.words import chunks, hashed_words, mix, shingle_sets
from cartage.session import materialize, scratch

WIDTH = 5  # words of a shingle
PERCENT = 75  # least similarity of a link, in percent
ROWS, BANDS = 5, 40
BINS = 2 * ROWS * BANDS  # the bands take every other bin, the sketch takes all
CELL = 64  # members that one task compares with one centre before the centre is copied to another cell
BLOCK = 512  # members of a bucket that meet in one task when a bucket holds several components
BLOCK_SHINGLES = 1 << 21  # shingles of those members, about
SKETCH_FLOOR = 0.66  # a pair at PERCENT is over four standard deviations above this share of equal bins
SKETCHED = 256  # shingles; pairs with a smaller set are told by their sets alone, as their sketches scatter more

_U = np.uint64
_BIN_SALT = mix(np.arange(1, BINS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_ROW_SALT = mix(_BIN_SALT[::2]) | _U(1)


def densified(shingles: np.ndarray) -> np.ndarray:
    """One value per bin for a sorted, non-empty array of shingle hashes."""
    bins = ((shingles >> _U(32)) * _U(BINS) >> _U(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    values, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[bins[first]], full[bins[first]] = shingles[first], True
    if len(first) == 1:
        return np.full(BINS, shingles[0], np.uint64)
    empty, attempt = np.flatnonzero(~full), 0
    while len(empty):
        attempt += 1
        probe = (mix(_BIN_SALT[empty] + _U(attempt)) % _U(BINS)).astype(np.int64)
        hit = full[probe]
        values[empty[hit]] = values[probe[hit]]
        empty = empty[~hit]
    return values


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for first, end, raw in chunks(texts):
            sizes, signs, bands, marks = [], [], [], []
            for shingles in shingle_sets(*hashed_words(raw), WIDTH):
                sizes.append(len(shingles))
                if not len(shingles):
                    signs.append(None), bands.append(None), marks.append(None)
                    continue
                signs.append(np.array([np.add.reduce(shingles), np.bitwise_xor.reduce(mix(shingles))]).tobytes())
                values = densified(shingles)
                keyed = mix(values + _BIN_SALT)
                bands.append(mix((keyed[::2] * _ROW_SALT).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)).view(np.int64))
                marks.append((keyed & _U(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, end - first),
                    pa.array(sizes, pa.int64()),
                    pa.array(signs, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(marks, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "signature", "bands", "sketch"],
            )


def sketches(docs: DataFrame) -> DataFrame:
    """Per document: size of its shingle set, a signature equal only for equal sets, bucket keys, a byte per bin."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sketch_batches,
        "doc_id long, n_shingles long, signature binary, bands array<long>, sketch binary",
    )


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (centre, cell, role): the centre's text comes first, its members stream past it."""
    key, centre = None, None
    for batch in batches:
        hubs, cells, roles, members = (batch.column(c).to_pylist() for c in ("a", "cell", "role", "need"))
        linked: list[tuple[int, int]] = []
        for first, end, raw in chunks(batch.column("text").to_pylist()):
            for i, shingles in zip(range(first, end), shingle_sets(*hashed_words(raw), WIDTH), strict=True):
                if roles[i] == 0:
                    key, centre = (hubs[i], cells[i]), shingles
                elif key == (hubs[i], cells[i]):
                    shared = len(np.intersect1d(centre, shingles, assume_unique=True))
                    if 100 * shared >= PERCENT * (len(centre) + len(shingles) - shared) and shared:
                        linked.append((hubs[i], members[i]))
        if linked:
            yield pa.RecordBatch.from_pylist(
                [{"a": a, "b": b} for a, b in linked], pa.schema([("a", pa.int64()), ("b", pa.int64())])
            )


def verified(pairs: DataFrame, docs: DataFrame, uri: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity.

    A centre that many pairs share is copied to one cell per ``CELL`` members, so no task sees a whole
    hot group and a task holds one centre's set and one batch.
    """
    pairs = materialize(pairs, f"{uri}-pairs")
    degree = materialize(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), f"{uri}-degree")
    asked = pairs.join(degree, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / CELL)).alias("cell"), F.col("b").alias("need"), F.lit(1).alias("role")
    )
    asked = materialize(asked, f"{uri}-asked")
    hubs = asked.select("a", "cell").distinct().select("a", "cell", F.col("a").alias("need"), F.lit(0).alias("role"))
    texts = docs.select(F.col("doc_id").cast("long").alias("need"), "text").where("need is not null and text is not null")
    # the texts always move by hash: what is asked for grows with them, so its broadcast would not last
    rows = asked.unionByName(hubs).join(texts.hint("merge"), "need").repartition("a", "cell")
    return rows.sortWithinPartitions("a", "cell", "role").mapInArrow(_verify_batches, "a long, b long")


_MEMBER = "bucket long, p int, q int, side int, rep long, component long, n_shingles long, bands array<long>, sketch binary"


def _blocks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[dict[str, list]]:
    """The rows of one (bucket, p, q) after another; batches are sorted by it."""
    held, key = {c: [] for c in columns}, None
    for batch in batches:
        rows = batch.to_pydict()
        for i in range(batch.num_rows):
            now = (rows["bucket"][i], rows["p"][i], rows["q"][i])
            if now != key:
                if key is not None:
                    yield held
                key, held = now, {c: [] for c in columns}
            for c in columns:
                held[c].append(rows[c][i])
    if key is not None:
        yield held


class _Block:
    """Members that meet in one task: both sides of two blocks of a bucket, or one block with itself."""

    def __init__(self, held: dict[str, list]):
        self.marks = np.frombuffer(b"".join(held["sketch"]), np.uint8).reshape(-1, BINS)
        self.bands, self.bucket = np.array(held["bands"]), held["bucket"][0]
        self.sizes, self.parts = np.array(held["n_shingles"]), np.array(held["component"])
        sides = np.array(held["side"])
        self.left = np.flatnonzero(sides == 0)
        self.right = np.flatnonzero(sides == 1) if held["p"][0] != held["q"][0] else self.left

    def partners(self, i: int) -> np.ndarray:
        """Members across from ``i`` in another component that may link with it and share no earlier bucket."""
        near = self.right[self.parts[self.right] != self.parts[i]]
        small, large = np.minimum(self.sizes[near], self.sizes[i]), np.maximum(self.sizes[near], self.sizes[i])
        near = near[(100 * small >= PERCENT * large)]
        small = np.minimum(self.sizes[near], self.sizes[i])
        near = near[(small < SKETCHED) | ((self.marks[near] == self.marks[i]).mean(axis=1) >= SKETCH_FLOOR)]
        if not len(near):
            return near
        first = (self.bands[near] == self.bands[i]).argmax(axis=1)
        return near[self.bands[i][first] == self.bucket]


def _open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block the members that may link with one in another component."""
    columns = ("bucket", "p", "q", "side", "rep", "component", "n_shingles", "bands", "sketch")
    for held in _blocks(batches, columns):
        block = _Block(held)
        wanted = np.zeros(len(held["rep"]), bool)
        for i in block.left:
            near = block.partners(i)
            wanted[near] = True
            wanted[i] |= len(near) > 0
        at = np.flatnonzero(wanted)
        if len(at):
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([held[c][i] for i in at], kind) for c, kind in zip(columns, kinds, strict=True)], names=list(columns)
            )


def _forest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block links, confirmed on full sets, that join its components: fewer than the block has members."""
    columns = ("bucket", "p", "q", "side", "rep", "component", "n_shingles", "bands", "sketch", "text")
    for held in _blocks(batches, columns):
        sets: list[np.ndarray] = []
        for _, _, raw in chunks(held.pop("text")):
            sets += shingle_sets(*hashed_words(raw), WIDTH)
        block, found = _Block(held), []
        for i in block.left:
            for j in block.partners(i):
                if block.parts[i] == block.parts[j]:
                    continue  # joined since
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * shared >= PERCENT * (len(sets[i]) + len(sets[j]) - shared) and shared:
                    found.append((held["rep"][i], held["rep"][j]))
                    block.parts[block.parts == block.parts[j]] = block.parts[i]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def crossing_links(members: DataFrame, docs: DataFrame, across: bool, uri: str) -> DataFrame:
    """Links that the stars left open: one bucket, two components.

    Buckets within one component are finished. The others are compared in blocks of about ``BLOCK`` members: each with
    itself, or with ``across`` each with every other one. Members that may link, by sizes and sketches, go on with
    their texts, and a block gives a spanning forest of its links, so neither step gives more rows than it takes.
    """
    span = members.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"),
        F.sum("n_shingles").alias("shingles"),
    )
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    mixed = span.where("low <> high").select("bucket", blocks.alias("blocks"))
    mixed = materialize(mixed.where("blocks > 1") if across else mixed, f"{uri}-mixed")
    rows = members.join(mixed, "bucket").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    if across:
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("own <> other")
    else:
        rows = rows.withColumn("other", F.col("own"))
    rows = rows.select(
        "bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "component", "n_shingles", "bands", "sketch",
    )
    dealt = rows.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q")
    wanted = materialize(dealt.mapInArrow(_open_members, _MEMBER), f"{uri}-open")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").where("rep is not null and text is not null")
    # the texts always move by hash: what is asked for grows with them, so its broadcast would not last
    full = wanted.join(texts.hint("merge"), "rep").repartition("bucket", "p", "q")
    links = full.sortWithinPartitions("bucket", "p", "q", "rep").mapInArrow(_forest_batches, "a long, b long")
    return materialize(links, f"{uri}-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``; other columns are ignored.

    Documents link when their sets of distinct five-word shingles reach a Jaccard similarity of 0.75;
    fewer words form one shingle. Null, empty and blank texts have no shingles and link with nothing.
    Rows that repeat a doc_id count as one document. A row without doc_id links with nothing, has no
    component_id and is kept. An empty table gives an empty result.

    Equal sets collapse into their smallest doc_id first. Each bucket then proposes a star around its
    smallest member, all of it confirmed on full sets; buckets that still span components are compared
    in blocks, first each with itself, then with the others, so that no link between components is lost.
    """
    spark = docs.sparkSession
    uri = scratch(spark, "minhash")
    sketched = materialize(sketches(docs), f"{uri}/sketches")
    classes = materialize(
        sketched.where("n_shingles > 0 and doc_id is not null")
        .groupBy("signature", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        f"{uri}/classes",
    )
    in_bucket = classes.select(F.explode("bands").alias("bucket"), "rep")
    centres = materialize(
        in_bucket.groupBy("bucket").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "a"),
        f"{uri}/centres",
    )
    shared = materialize(in_bucket.join(centres, "bucket"), f"{uri}/shared")
    stars = shared.where("a <> rep").select("a", F.col("rep").alias("b")).distinct()
    links = materialize(verified(stars, docs, f"{uri}/star"), f"{uri}/star-links")
    found = materialize(components(links), f"{uri}/first")

    joined = found
    for across in (False, True):
        marked = classes.select("rep", "n_shingles", "bands", "sketch").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        marked = marked.withColumn("component", F.coalesce("component", "rep"))
        members = shared.select("bucket", "rep").join(marked, "rep")
        more = crossing_links(members, docs, across, f"{uri}/{'across' if across else 'within'}")
        if not more.isEmpty():
            known = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
            joined = components(known.unionByName(more))

    # one document may stand in several classes when rows repeat a doc_id: its classes are one node already
    same = joined.withColumnRenamed("node", "rep")
    of_class = classes.select("signature", "n_shingles", "rep").join(same, "rep", "left")
    of_class = materialize(
        of_class.select("signature", "n_shingles", F.coalesce("component", "rep").alias("component_id")), f"{uri}/named"
    )
    out = sketched.select("doc_id", "n_shingles", "signature").join(of_class, ["signature", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
        (F.col("doc_id").isNull() | (own == F.col("doc_id"))).alias("kept"),
    )
