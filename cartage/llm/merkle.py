"""Merkle manifest of a dataset: one tree per source over its rows, one tree over the sources.

Level by level, fixed-offset lag and lead columns, masked by a node's slot in its run of FANOUT and by the run's length,
supply its siblings; the first child of a run hashes its parent. On the way up only digests are written; on
the way down every node appends its siblings to its parent's path, so a row's path meets it after one shuffle.
Every window holds one run, whatever the size of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartage.session import materialize, scratch

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5  # one id in so many is tampered with
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(*values: Column) -> Column:
    """Lowercase hex sha256 of the values: ``-`` for a null, else its UTF-8 byte count, ``:`` and itself."""
    parts = []
    for value in values:
        value = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def lower_cased(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased where TAMPERED divides the crc32 of the decimal id, else as it is."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED == 0
    return F.when(hit, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def _numbered(rows: DataFrame, order: list[str], uri: str) -> DataFrame:
    """``rows`` with ``pos``, their place within ``tree`` by ``order`` (nulls first), and ``n``, the rows of their tree.

    Each task numbers a range of (tree, order) and adds what the tree has in the ranges before, so a tree of any size
    is spread. ``spread`` tells rows apart that are equal in ``order``, and is dropped; such rows must be equal.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(ranges, "tree", *order, "spread").drop("spread").withColumn("part", F.spark_partition_id())
    placed = materialize(placed, f"{uri}/placed")
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("held"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"), F.sum("held").over(tree).alias("n")
    )
    within = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order)) - 1
    numbered = placed.withColumn("within", within).join(materialize(starts, f"{uri}/starts"), ["tree", "part"])
    numbered = numbered.withColumn("pos", F.col("start") + F.col("within")).drop("part", "start", "within")
    return materialize(numbered, f"{uri}/numbered")


def _in_runs(nodes: DataFrame) -> DataFrame:
    run = F.floor(F.col("pos") / FANOUT).cast("long")
    nodes = nodes.withColumn("run", run).withColumn("slot", (F.col("pos") % FANOUT).cast("int"))
    return nodes.withColumn("held", F.least(F.lit(FANOUT), F.col("n") - F.col("run") * FANOUT))


def _run_order() -> Window:
    return Window.partitionBy("tree", "run").orderBy("pos")


def _after() -> Column:
    """The digests of a node's later siblings, in order: leads that stay within its run."""
    leads = [F.when(F.col("slot") + k < F.col("held"), F.lead("digest", k).over(_run_order())) for k in range(1, FANOUT)]
    return F.concat_ws("", *leads)


def _before() -> Column:
    """The digests of a node's earlier siblings, in order: lags that stay within its run."""
    lags = [F.when(F.col("slot") >= k, F.lag("digest", k).over(_run_order())) for k in range(FANOUT - 1, 0, -1)]
    return F.concat_ws("", *lags)


class Forest:
    """Trees over numbered nodes ``(tree, n, pos, digest)``: their levels, and the top of each tree."""

    def __init__(self, nodes: DataFrame, uri: str):
        self.uri = uri
        self.levels: list[DataFrame] = []
        widest = nodes.agg(F.max("n")).first()[0] or 0
        level, tops = nodes.select("tree", "n", "pos", "digest"), []
        while True:
            tops.append(level.where("n = 1").select("tree", "digest", F.lit(len(self.levels)).alias("depth")))
            if widest <= 1:
                break
            level = level.where("n > 1")
            self.levels.append(level)
            firsts = _in_runs(level).withColumn("after", _after()).where("slot = 0")
            above = firsts.select(
                "tree", F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), F.col("run").alias("pos"),
                F.sha2(F.concat("digest", "after"), 256).alias("digest"),
            )
            widest = -(-widest // FANOUT)
            level = materialize(above, f"{uri}/level-{len(self.levels)}")
        roots = tops[0]
        for more in tops[1:]:
            roots = roots.unionByName(more)
        self.tops = materialize(roots, f"{uri}/tops")

    def nodes(self) -> DataFrame:
        """``(tree, level, pos, digest)`` of every node, leaves at level 0; a tree's last level is its top."""
        out = self.tops.select("tree", F.col("depth").alias("level"), F.lit(0).cast("long").alias("pos"), "digest")
        for number, level in enumerate(self.levels):
            out = out.unionByName(level.select("tree", F.lit(number).alias("level"), "pos", "digest"))
        return out

    def paths(self, nodes: DataFrame, above: DataFrame) -> DataFrame:
        """``nodes`` (of level 0, with any further columns) with their ``path`` and the columns of ``above``.

        A path lists, from the node upwards, the digests of the siblings to the left and to the right. ``above`` has
        per tree its ``depth``, the path that goes on from its top, and whatever else every node of it is to get.
        """
        carried = [c for c in above.columns if c not in ("tree", "depth", "path")]

        def ends(depth: int) -> DataFrame:
            return above.where(F.col("depth") == depth).select("tree", F.lit(0).cast("long").alias("run"), "path", *carried)

        lone = nodes.where("n = 1").join(ends(0).drop("run"), "tree")
        if not self.levels:
            return lone
        parents = ends(len(self.levels))
        for number in range(len(self.levels) - 1, 0, -1):
            found = self._extended(self.levels[number], parents, carried)
            found = found.select("tree", F.col("pos").alias("run"), "path", *carried)
            parents = materialize(found.unionByName(ends(number)), f"{self.uri}/paths-{number}")
        many = self._extended(nodes.where("n > 1"), parents, carried)
        return many.select(lone.columns).unionByName(lone)

    def _extended(self, level: DataFrame, parents: DataFrame, carried: list[str]) -> DataFrame:
        beside = _in_runs(level).withColumn("beside", F.struct(_before().alias("left"), _after().alias("right")))
        joined = beside.join(parents.withColumnRenamed("path", "rest"), ["tree", "run"])
        return joined.select(*level.columns, F.concat(F.array("beside"), "rest").alias("path"), *carried)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings along its path give."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """sha256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def merkle_proofs(docs: DataFrame, tamper=lower_cased) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row of ``docs``.

    A leaf is the digest of FIELDS. Per source, leaves in order of doc_id (null first, equal ids by leaf) form a tree
    of runs of FANOUT; its top, a lone leaf itself, is ``subroot``. The subroots by source (null first, else bytewise)
    form the tree of ``root``. ``folded_root`` is what the row with ``tamper(doc_id, text)`` as its text gives along the
    original siblings; ``verified`` says whether that is the root. A null id is not tampered with. Rows that repeat
    each other are leaves of their own with the same digest, in places that are interchangeable; null sources form
    one tree. Columns other than FIELDS are ignored; an empty table gives an empty result.
    """
    uri = scratch(docs.sparkSession, "merkle")
    id_, text = F.col("doc_id"), F.col("text")
    others = [F.col(c) for c in FIELDS[:-1]]
    changed = tamper(id_, text)
    # null sources sort before all others, as the empty string does before "+..."
    tree = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit(""))
    leaves = materialize(
        docs.select(
            tree.alias("tree"), "doc_id", digest_of(*others, text).alias("digest"),
            F.when(~changed.eqNullSafe(text), digest_of(*others, changed)).alias("forged"),
            F.monotonically_increasing_id().alias("spread"),
        ),
        f"{uri}/leaves",
    )
    rows = _numbered(leaves, ["doc_id", "digest"], f"{uri}/rows")
    sources = Forest(rows, f"{uri}/sources")
    subroots = sources.tops.select(
        F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("depth").alias("height"), "digest", F.lit(0).alias("spread")
    )
    subroots = _numbered(subroots, ["source"], f"{uri}/subroots")
    whole = Forest(subroots, f"{uri}/whole")
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    ends = whole.tops.select("tree", "depth", F.col("digest").alias("root"), nothing.alias("path"))
    above = whole.paths(subroots, ends).select(
        F.col("source").alias("tree"), F.col("height").alias("depth"), F.col("digest").alias("subroot"), "root", "path"
    )
    found = sources.paths(rows, materialize(above, f"{uri}/above"))
    out = found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("forged", "digest"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
