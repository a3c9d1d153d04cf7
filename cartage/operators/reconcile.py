"""Reconciliation: do plan, stage and target agree, key by key?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartage.functions.keys import join_on_keys, other_key
from cartage.functions.types import quoted
from cartage.operators.logs import StateLog
from cartage.operators.target import Target, read_target
from cartage.plans.profile import partition_profile


def compare_counts(planned: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer comparison of two grouped counts (``planned_rows``, ``actual_rows``).

    Both sides hold one row per key, so however skewed the data is, the join is
    not. A key missing on one side counts as zero rows there.
    """
    joined = join_on_keys(planned, actual, keys, "full_outer")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        *[F.coalesce(F.col(quoted(k)), F.col(quoted(other_key(k)))).alias(k) for k in keys],
        F.coalesce("planned_rows", zero).alias("planned_rows"),
        F.coalesce("actual_rows", zero).alias("actual_rows"),
        F.coalesce(F.col("planned_rows") == F.col("actual_rows"), F.lit(False)).alias("matched"),
    )


def reconcile_export(log: StateLog, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows the log planned per partition against the rows found in the staged files."""
    planned = log.current().filter("status = 'COMPLETED'").select("part_key.*", F.col("total_rows").alias("planned_rows"))
    return compare_counts(planned, partition_profile(staged, keys, counted="actual_rows"), keys)


def reconcile_import(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key of the source table against those of the loaded table."""
    planned = partition_profile(source, keys, counted="planned_rows")
    return compare_counts(planned, partition_profile(target, keys, counted="actual_rows"), keys)


def reconcile_files(target: Target) -> DataFrame:
    """Rows the file log reports as loaded against the rows the target returns."""
    logged = target.files.current().filter("status = 'SUCCESS'").agg(
        F.coalesce(F.sum("rows_loaded"), F.lit(0).cast("bigint")).alias("planned_rows")
    )
    found = read_target(target).agg(F.count(F.lit(1)).alias("actual_rows"))
    # two single-row frames
    return logged.join(found, F.lit(True)).withColumn("matched", F.col("planned_rows") == F.col("actual_rows"))
