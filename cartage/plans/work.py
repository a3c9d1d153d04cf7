"""Work plans over a profile: order, batches, waves and file counts.

A profile has one row per partition, so these plans never touch the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartage.functions.types import quoted
from cartage.session import materialize

# Fixed value: the largest file an unload may write, which is also its default.
MAX_FILE_SIZE = 5_368_709_120

_RANGE = "__range"
_START = "__start"


def smallest_first(profile: DataFrame, keys: Sequence[str], n: int, counted: str = "total_rows") -> DataFrame:
    """The ``n`` smallest partitions, ties broken by key."""
    return profile.orderBy(counted, *[F.col(quoted(k)) for k in keys]).limit(n)


def with_rank(plan: DataFrame, order: Sequence[str], work_uri: str) -> DataFrame:
    """Add ``slot``: 0 for the first row by ``order``, 1 for the next, and so on.

    Each task numbers a range of the order and adds what lies in the ranges
    before it. The ranges are written first, so that a rerun task cannot see
    other ones. ``order`` must be unique.
    """
    columns = [F.col(quoted(c)) for c in order]
    ranges = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = plan.repartitionByRange(ranges, *columns).withColumn(_RANGE, F.spark_partition_id())
    placed = materialize(placed, work_uri)
    # one row per range
    sizes = placed.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_RANGE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_START))
    within = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*columns)) - 1
    numbered = placed.withColumn("slot", within).join(starts, _RANGE)
    return numbered.withColumn("slot", (F.col("slot") + F.col(_START)).cast("bigint")).drop(_RANGE, _START)


def ranked_waves(
    profile: DataFrame, keys: Sequence[str], wave_size: int, work_uri: str, counted: str = "total_rows"
) -> DataFrame:
    """Wave number of every partition, smallest partitions first."""
    ranked = with_rank(profile, [counted, *keys], work_uri)
    return ranked.withColumn("wave", F.floor(F.col("slot") / wave_size).cast("int")).drop("slot")


def wave_ranges(total: int, wave_size: int | None) -> list[tuple[int, int]]:
    """Slot ranges of at most ``wave_size`` rows each; ``None`` means one wave."""
    width = wave_size or total
    return [(lo, min(lo + width, total)) for lo in range(0, total, width)] if total else []


def file_count(estimated_bytes: Column, max_file_size: int, headroom: float = 1.0) -> Column:
    """Files a partition needs so that none exceeds the size cap.

    Rows dealt out by hash do not split evenly to the row; with ``headroom``
    below 1 the files of a split partition are planned that much smaller.
    """
    split = F.ceil(estimated_bytes / F.lit(max_file_size * headroom))
    return F.when(estimated_bytes <= max_file_size, F.lit(1)).otherwise(split).cast("bigint")


def rows_per_file(row_bytes: float, max_file_size: int) -> int:
    """Row cap of one file for an average row size."""
    return max(1, int(max_file_size / max(row_bytes, 1e-9)))


def file_cap_plan(profile: DataFrame, rows_per_file_cap: int, counted: str = "total_rows") -> DataFrame:
    """Files per partition under a row cap per file."""
    return profile.withColumn("file_count", file_count(F.col(counted), rows_per_file_cap))
