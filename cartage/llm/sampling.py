"""Deterministic folds and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def bounded(rows: DataFrame, group: str, most: int, key: str = "doc_id", groups: int = 512) -> DataFrame:
    """About ``most`` rows of each of the ``groups`` most frequent values of ``group``, chosen by a hash of ``key``.

    The groups' sizes are counted over all rows and set the rate, so a hot group gives no more than a
    rare one. Rows of equal key are drawn together.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n"), group).limit(groups)
    draw = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.join(F.broadcast(sizes), group).where(draw * F.col("__n") < most).drop("__n")
