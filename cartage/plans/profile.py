"""Partition profiles: which key values a table holds and how much lies behind each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartage.functions.keys import join_on_keys
from cartage.functions.types import quoted, row_bytes


def partition_profile(
    df: DataFrame, keys: Sequence[str], measure_bytes: bool = False, counted: str = "total_rows"
) -> DataFrame:
    """Rows per key; NULL is a key of its own.

    Only the key columns are scanned and counts are combined before the shuffle,
    so a hot key costs one row per task. Measuring bytes reads every column.
    """
    measures = [F.count(F.lit(1)).alias(counted)]
    if measure_bytes:
        measures.append(F.sum(row_bytes(df.schema)).alias("input_bytes"))
    return df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(*measures)


def daily(df: DataFrame, ts: Column, name: str = "day") -> DataFrame:
    """The table with a day key, the usual partition key of a large event table."""
    return df.withColumn(name, F.to_date(ts))


def partition_bytes(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Value bytes per key over ``columns`` (all by default)."""
    measured = df.select(*[quoted(c) for c in columns]).schema if columns else df.schema
    return df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(
        F.sum(row_bytes(measured)).alias("input_bytes")
    )


def new_partitions(profile: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Profile rows whose key no log row holds; a NULL key matches a logged NULL key."""
    return join_on_keys(profile, known, keys, "left_anti")
