"""Append-only state logs.

Spark's Parquet tables have no UPDATE, and a log that is only appended to keeps
the whole history for audits. Every append writes one folder ``seq=N``; the
write job marks the folder as its very last step, and folders without that mark
are ignored. An append is therefore seen whole or not at all, whichever executor
dies meanwhile. The current state of a key is its row with the highest ``seq``.

Every append claims its number by creating a file, so writers that meet keep each other's rows;
runs on one stage still go one at a time. Readers are free.

Every ``SNAPSHOT_EVERY`` appends the current state is written down beside them, so reading it takes that
snapshot and the few appends since, however long the history. The history itself stays whole.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartage.functions.types import quoted
from cartage.session import create_file, glob_paths, literal_path

SNAPSHOT_EVERY = 24  # appends after which the current state is written down

# States of partitions, files and runs.
PARTITION_STATES = ("NOT_SELECTED", "PENDING", "IN_PROGRESS", "COMPLETED", "FAILED")
FILE_STATES = ("PENDING", "IN_PROGRESS", "RETRYING_FULL_INGEST", "SUCCESS", "FAILED")
# of files that replace others: loaded but not yet part of the table, and no longer part of it
LOADED, REPLACED = "LOADED", "REPLACED"
RUN_STATES = ("CREATED", "RUNNING", "COMPLETED", "FAILED", "SUSPENDED")

PARTITION_COLUMNS = (
    "base_key string, path_key string, status string, task_id string, total_rows bigint, "
    "rows_unloaded bigint, input_bytes bigint, output_bytes bigint, file_count bigint, "
    "retry_count int, error_message string, started_at timestamp, ended_at timestamp, "
    "generation string, staged_files array<string>"
)
FILE_COLUMNS = (
    "file_path string, source_uri string, length bigint, target_path string, status string, "
    "task_id string, load_mode_used string, rows_parsed bigint, rows_loaded bigint, retry_count int, "
    "error_message string, started_at timestamp, ended_at timestamp, generation string, replaces boolean"
)
RUN_COLUMNS = (
    "task_id string, operation string, source string, target string, stage_uri string, "
    "parameters string, status string, total_items bigint, completed_items bigint, "
    "failed_items bigint, error_message string, created_at timestamp, started_at timestamp, ended_at timestamp, "
    "fallback_items bigint, replaced_items bigint"
)


def fold(
    history: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, order: str = "seq"
) -> DataFrame:
    """Latest row per key, all of it or some ``columns``.

    ``max_by`` combines before the shuffle, so a long history of one key costs one
    row per task. Naming the columns keeps the others out of the scan.
    """
    rest = [c for c in columns or history.columns if c not in keys]
    latest = F.max_by(F.struct(*[F.col(quoted(c)) for c in rest]), F.col(order)).alias("latest")
    return history.groupBy(*[F.col(quoted(k)) for k in keys]).agg(latest).select(*[F.col(quoted(k)) for k in keys], "latest.*")


def latest_status(
    history: DataFrame, keys: Sequence[str], states: Sequence[str], order: str = "seq"
) -> DataFrame:
    """Latest ``order`` and status per key, which is all that counting reports need.

    The status is folded as a small number: with values of fixed width Spark
    aggregates by hash, where texts would make it sort the history first.
    """
    names = F.array(*[F.lit(s) for s in states])
    code = F.array_position(names, F.col("status")).cast("int")
    folded = history.groupBy(*[F.col(quoted(k)) for k in keys]).agg(
        F.max(order).alias(order), F.max_by(code, order).alias("code")
    )
    return folded.select(
        *[F.col(quoted(k)) for k in keys], order, F.get(names, F.col("code") - 1).alias("status")
    )


def ddl_schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


class StateLog:
    """A log of state rows below one URI, folded by ``keys``."""

    def __init__(self, spark: SparkSession, uri: str, schema: T.StructType, keys: Sequence[str]):
        self.spark = spark
        self.uri = uri.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self._commits: list[tuple[int, int]] | None = None

    @property
    def _items(self) -> str:
        return f"{self.uri}/items"

    def _folder(self, generation: int, seq: int) -> str:
        return f"{self._items}/generation={generation}/seq={seq}"

    def exists(self) -> bool:
        return bool(self._latest())

    def refresh(self) -> None:
        """Look again for what other writers have appended."""
        self._commits = None

    def commits(self) -> list[tuple[int, int]]:
        """``(generation, seq)`` of every complete append, of earlier generations too."""
        marks = glob_paths(self.spark, f"{literal_path(self._items)}/generation=*/seq=*/_SUCCESS")
        found = [re.search(r"/generation=(\d+)/seq=(\d+)/_SUCCESS$", m) for m in marks]
        return sorted((int(m[1]), int(m[2])) for m in found)

    def _latest(self) -> list[tuple[int, int]]:
        """The appends of the current generation, the last one that has any; earlier ones are not listed."""
        if self._commits is None:
            self._commits = []
            folders = [re.search(r"/generation=(\d+)$", f) for f in glob_paths(self.spark, f"{literal_path(self._items)}/generation=*")]
            for generation in sorted((int(f[1]) for f in folders if f), reverse=True):
                marks = glob_paths(self.spark, f"{literal_path(self._items)}/generation={generation}/seq=*/_SUCCESS")
                if marks:
                    self._commits = sorted((generation, int(re.search(r"/seq=(\d+)/_SUCCESS$", m)[1])) for m in marks)
                    break
        return self._commits

    def _generation(self) -> int:
        return max((g for g, _ in self._latest()), default=0)

    def _current_seqs(self) -> list[int]:
        return [s for _, s in self._latest()]

    def _read(self, folders: list[str], base: str | None = None) -> DataFrame:
        schema = T.StructType([*self.schema, *ddl_schema("event string, at timestamp, seq bigint")])
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if base:
            reader = reader.option("basePath", base)
        return reader.parquet(*[literal_path(f) for f in folders]).select(*schema.names)

    def history(self, seqs: Sequence[int] | None = None) -> DataFrame:
        """Every row of the current generation, or of some of its appends, with the ``seq`` and event of its append."""
        generation = self._generation()
        folders = [self._folder(generation, s) for s in (self._current_seqs() if seqs is None else seqs)]
        return self._read(folders, f"{self._items}/generation={generation}")

    def _snapshot(self) -> tuple[str, int, set[int]] | None:
        """The newest complete snapshot of the generation: its folder, the last append it covers, and the
        numbers up to that one which had no complete append when it was written.
        """
        pattern = f"{literal_path(self.uri)}/snapshots/generation-{self._generation()}-upto-*/_SUCCESS"
        found = []
        for mark in glob_paths(self.spark, pattern):
            name = re.search(r"/generation-\d+-upto-(\d+)-without-([\d_]*)/_SUCCESS$", mark)
            found.append((int(name[1]), {int(x) for x in name[2].split("_") if x}, mark.rsplit("/", 1)[0]))
        if not found:
            return None
        last, without, folder = max(found, key=lambda f: (f[0], -len(f[1])))
        return folder, last, without

    def _uncovered(self, snapshot: tuple[str, int, set[int]] | None) -> list[int]:
        if snapshot is None:
            return self._current_seqs()
        _, last, without = snapshot
        return [s for s in self._current_seqs() if s > last or s in without]

    def current(self) -> DataFrame:
        """The latest row of every key: from the last snapshot and the appends it does not cover."""
        snapshot = self._snapshot()
        if snapshot is None:
            return fold(self.history(), self.keys)
        rows = self._read([snapshot[0]])
        late = self._uncovered(snapshot)
        return fold(rows.unionByName(self.history(late)) if late else rows, self.keys)

    def write_snapshot(self) -> None:
        """Write the current state down. An append that ends later under a lower number is still read on its own."""
        self.refresh()
        seqs = self._current_seqs()
        if not seqs:
            return
        without = sorted(set(range(min(seqs), max(seqs))) - set(seqs))
        name = f"generation-{self._generation()}-upto-{max(seqs)}-without-{'_'.join(map(str, without))}"
        self.current().write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(
            f"{self.uri}/snapshots/{name}"
        )

    def append(self, rows: DataFrame, event: str = "", generation: int | None = None) -> int:
        """Add state rows; they become visible together when the write job is done."""
        known = self._latest()
        generation = self._generation() if generation is None else generation
        seq = max((s for _, s in known), default=0) + 1
        while not create_file(self.spark, f"{self.uri}/claims/{seq}"):
            # another writer took this number, or died with it: its rows are not to be overwritten
            seq += 1
        shaped = rows.select(
            *[F.col(quoted(f.name)).cast(f.dataType) for f in self.schema],
            F.lit(event).alias("event"),
            F.current_timestamp().alias("at"),
        )
        # a crash half way leaves an unmarked folder, which this overwrite replaces
        (
            shaped.write.mode("overwrite")
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
            .parquet(self._folder(generation, seq))
        )
        if known and known[0][0] != generation:
            known.clear()
        known.append((generation, seq))
        if len(known) % SNAPSHOT_EVERY == 0:
            self.write_snapshot()
        return seq

    def transition(self, rows: DataFrame, event: str = "", **changes: Column) -> int:
        """Append ``rows`` (in the log's shape) with some columns changed."""
        kept = [F.col(quoted(f.name)) for f in self.schema if f.name not in changes]
        changed = [value.alias(name) for name, value in changes.items()]
        return self.append(rows.select(*kept, *changed), event)

    def start_fresh(self) -> None:
        """Begin a new generation: earlier rows stay on disk but no longer count."""
        if self._latest():
            self.append(self.spark.createDataFrame([], self.schema), "fresh", self._generation() + 1)

    def compact(self) -> None:
        """Carry only the current state over into a new generation."""
        state = self.current().select(*self.schema.names)
        self.append(state, "compacted", self._generation() + 1)


def partition_log(spark: SparkSession, uri: str, key_schema: T.StructType) -> StateLog:
    """Log of one table's partitions; the key keeps its source types."""
    schema = T.StructType([T.StructField("part_key", key_schema), *ddl_schema(PARTITION_COLUMNS)])
    return StateLog(spark, uri, schema, ["part_key"])


def file_log(spark: SparkSession, uri: str) -> StateLog:
    """Log of the files loaded into one target; its SUCCESS rows are the target's manifest.

    Keyed by the full source URI: two stages may hold files of the same relative path.
    """
    return StateLog(spark, uri, ddl_schema(FILE_COLUMNS), ["source_uri"])


def run_log(spark: SparkSession, uri: str) -> StateLog:
    """Registry of runs."""
    return StateLog(spark, uri, ddl_schema(RUN_COLUMNS), ["task_id"])


def with_status(state: DataFrame, *statuses: str) -> DataFrame:
    return state.filter(F.col("status").isin(*statuses))


def not_completed(state: DataFrame, done: str = "COMPLETED") -> DataFrame:
    """What a resumed run still has to do."""
    return state.filter(F.col("status") != done)


def failed_as_pending(state: DataFrame) -> DataFrame:
    """FAILED items back to PENDING with their error cleared, ready to be appended."""
    failed = with_status(state, "FAILED")
    return failed.withColumns({"status": F.lit("PENDING"), "error_message": F.lit(None).cast("string")})


def selected_as_pending(state: DataFrame, selection: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The selected items as PENDING, their retry count and error reset."""
    return as_pending(state.join(selection, list(keys), "left_semi"))


def as_pending(items: DataFrame) -> DataFrame:
    return items.withColumns(
        {
            "status": F.lit("PENDING"),
            "retry_count": F.lit(0),
            "error_message": F.lit(None).cast("string"),
        }
    )


def extended(state: DataFrame, discovered: DataFrame) -> DataFrame:
    """State plus newly discovered items; columns a discovery lacks are NULL."""
    return state.unionByName(discovered, allowMissingColumns=True)
