"""Connected components by alternating star contraction, every step a join or a combined aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartage.session import materialize, scratch


EDGES_PER_TASK = 100_000  # edges get smaller and fewer; so do the tasks that hold them


def _nearest(edges: DataFrame, uri: str, tasks: int) -> DataFrame:
    """Per node the smallest neighbour; written, so that the join on a hub's key can be split at run time."""
    return materialize(edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), uri)


def _large_star(edges: DataFrame, uri: str, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    nearest = _nearest(both, f"{uri}-large", tasks)
    larger = both.where("v > u").join(nearest, "u")
    return larger.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, uri: str, tasks: int) -> DataFrame:
    nearest = _nearest(edges, f"{uri}-small", tasks)
    moved = edges.join(nearest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(nearest.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of an edge, component being the smallest node reachable.

    ``edges`` has two columns of one orderable type; direction, repeats, self loops and nulls do not
    matter. Nodes that stand alone are not returned. Each round points every node at a smaller one, so
    the edges of a component end as a star around its smallest node; rounds grow with the logarithm of
    the longest chain. Every round is written to the shared scratch folder, and only two numbers per
    round reach the driver.
    """
    spark = edges.sparkSession
    uri = scratch(spark, "components")
    a, b = edges.columns
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, before, step = materialize(now, f"{uri}/0"), None, 0
    while True:
        count, digest = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if count == 0 or (count, digest) == before:
            break
        before, step, tasks = (count, digest), step + 1, count // EDGES_PER_TASK + 4
        large = materialize(_large_star(now, f"{uri}/{step}", tasks), f"{uri}/{step}-moved")
        now = materialize(_small_star(large, f"{uri}/{step}", tasks), f"{uri}/{step}")
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
