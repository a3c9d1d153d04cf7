"""Progress and audit reports over log states. Every report covers all runs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartage.functions.texts import BOTH_FAILED_NOTE, FALLBACK_PREFIX, clip_error, shortened, shown
from cartage.functions.types import quoted
from cartage.operators.logs import LOADED

# States that count as work to be done, and states of an active run.
EXPORT_STATES = ("PENDING", "IN_PROGRESS", "COMPLETED", "FAILED")
IMPORT_STATES = ("PENDING", "IN_PROGRESS", "SUCCESS", "FAILED")
ACTIVE_STATES = ("CREATED", "RUNNING")
RECENT_LIMIT = 100


def status_counts(state: DataFrame, states: Sequence[str] = EXPORT_STATES) -> DataFrame:
    """Items per status, zero for a status nobody has; other states are left out.

    One aggregate without a grouping key: each task sends a single row.
    """
    counts = [
        F.struct(F.lit(s).alias("status"), F.count_if(F.col("status") == s).alias("item_count")) for s in states
    ]
    return state.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def import_status_counts(state: DataFrame) -> DataFrame:
    """Files per status; a file that is being retried, or waits to replace others, is still in progress."""
    retrying = F.col("status").isin("RETRYING_FULL_INGEST", LOADED)
    merged = state.withColumn("status", F.when(retrying, "IN_PROGRESS").otherwise(F.col("status")))
    return status_counts(merged, IMPORT_STATES)


def progress(state: DataFrame, by: Sequence[str], done: str = "COMPLETED", ignored: str = "NOT_SELECTED") -> DataFrame:
    """Completed over selected items per group."""
    selected = state.filter(F.col("status") != ignored)
    return selected.groupBy(*[F.col(quoted(c)) for c in by]).agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(F.col("status") == done).alias("completed_items"),
        (F.count_if(F.col("status") == done) / F.count(F.lit(1))).alias("progress"),
    )


def run_progress(runs: DataFrame, state: DataFrame, done: str = "COMPLETED") -> DataFrame:
    """The registry with the live counts of each run's items beside it."""
    counts = progress(state, ["task_id"], done).withColumnRenamed("total_items", "selected_items")
    return runs.select("task_id", "operation", "status").join(counts, "task_id", "left")


def parameter(parameters: str, name: str, type_name: str = "string") -> Column:
    """One value out of a run's JSON parameters; NULL where the run has none of that name."""
    return F.try_variant_get(F.try_parse_json(parameters), f"$.{name}", type_name).alias(name)


def run_totals(state: DataFrame, by: Sequence[str], done: str) -> DataFrame:
    """Completed, failed and fallen-back items per run."""
    fell_back = (F.col("status") == done) & F.startswith(
        F.coalesce("error_message", F.lit("")), F.lit(FALLBACK_PREFIX)
    )
    return state.groupBy(*[F.col(quoted(c)) for c in by]).agg(
        F.count_if(F.col("status") == done).alias("completed_items"),
        F.count_if(F.col("status") == "FAILED").alias("failed_items"),
        F.count_if(fell_back).alias("fallback_items"),
    )


def run_summary(runs: DataFrame) -> DataFrame:
    """Registry totals: all, completed and failed runs."""
    return runs.agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count_if(F.col("status") == "COMPLETED").alias("completed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
    )


def load_mode_summary(state: DataFrame) -> DataFrame:
    """Files per load mode and status."""
    return state.groupBy("load_mode_used", "status").agg(F.count(F.lit(1)).alias("file_count"))


def error_audit(state: DataFrame) -> DataFrame:
    """Items with an error text, which is cut to the log's length."""
    return state.filter(F.col("error_message").isNotNull()).withColumn(
        "error_message", clip_error(F.col("error_message"))
    )


def failed_after_fallback(state: DataFrame) -> DataFrame:
    """Files for which both modes failed."""
    return state.filter((F.col("status") == "FAILED") & F.endswith("error_message", F.lit(BOTH_FAILED_NOTE)))


def fallback_audit(state: DataFrame) -> DataFrame:
    """Files that were ingested after their copy had failed; the log keeps the copy's error."""
    return state.filter(
        (F.col("status") == "SUCCESS")
        & (F.col("load_mode_used") == "FULL_INGEST")
        & F.startswith("error_message", F.lit(FALLBACK_PREFIX))
    )


def fallback_history(history: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items now in SUCCESS that were in RETRYING_FULL_INGEST at some time."""
    retried = history.filter("status = 'RETRYING_FULL_INGEST'").select(*keys).distinct()
    return state.filter("status = 'SUCCESS'").join(retried, list(keys), "left_semi")


def recent(runs: DataFrame, created: str, tiebreak: str, limit: int = RECENT_LIMIT) -> DataFrame:
    """Newest runs first."""
    return runs.orderBy(F.col(created).desc(), F.col(tiebreak).desc()).limit(limit)


def active(
    runs: DataFrame,
    created: str,
    tiebreak: str,
    prefix: str = "",
    states: Sequence[str] = ACTIVE_STATES,
    limit: int = RECENT_LIMIT,
) -> DataFrame:
    """Newest runs that are not finished, by name prefix."""
    chosen = runs.filter(F.col("status").isin(*states) & F.startswith(tiebreak, F.lit(prefix)))
    return recent(chosen, created, tiebreak, limit)


def log_view(state: DataFrame, order: Sequence[Column], limit: int | None = None) -> DataFrame:
    """A log for reading, all of it or its first rows: long texts cut, NULLs shown as blanks or zeros."""
    cells = []
    for f in state.schema:
        column, kind = F.col(quoted(f.name)), f.dataType.simpleString()
        if kind == "string":
            cells.append(shortened(shown(column, "")).alias(f.name))
        elif kind in ("int", "bigint"):
            cells.append(shown(column, 0).alias(f.name))
        else:
            cells.append(column)
    ordered = state.orderBy(*order)
    return (ordered.limit(limit) if limit else ordered).select(*cells)
