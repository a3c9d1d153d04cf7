"""Export: profile the partitions, select some, write each wave in one Spark job.

However many partitions a wave holds, it costs one scan and one shuffle. Each
partition gets its own folder; the partitions of a wave that cannot be written
are isolated by reading parts of it.
"""

from __future__ import annotations

import errno
import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pa_fs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartage.functions.keys import LITERAL_TYPES, assign_path_keys, base_path_key, partition_predicate, restrict_to_keys
from cartage.functions.texts import ERROR_LIMIT, RUN_PREFIX, run_title
from cartage.functions.types import compat_columns, quoted, row_bytes
from cartage.operators.cleanup import remove_files
from cartage.operators.logs import (
    StateLog,
    as_pending,
    failed_as_pending,
    not_completed,
    partition_log,
    run_log,
    selected_as_pending,
    with_status,
)
from cartage.plans.profile import new_partitions
from cartage.plans.work import MAX_FILE_SIZE, file_count, rows_per_file, wave_ranges, with_rank
from cartage.session import literal_path, materialize, one_row, path_exists, qualify, scanned_bytes, write_text
from cartage.sources.files import open_file, spread
from cartage.sources.tables import select_columns

_HEADROOM = 0.9
_GRAINS = 64  # steps in which rows are moved between the files of a partition
_EVEN_ROWS = 100_000  # rows per file from which on dealing by hash splits bytes evenly enough
_PROBES = 8  # reads at a time while failing partitions are told apart
_NAMED = 64  # partitions that a read names as literals, so that the scan can skip others
_TASK_BYTES = 1 << 30  # what a task writes, about
_OWN_BYTES = 1 << 26  # below this two partitions in one task are no loss
_REWRITES = 4  # of partitions found beyond the size cap, with more files each time
_ROW = "__row"
_FIRST = "__first_task"
_GRAIN = "__grain"
_FILE = "__file"
_RESERVED = ("path_key", "part_key", "file_count", _ROW, _FIRST, _GRAIN, _FILE)


@dataclass
class ExportRun:
    """What a run left behind."""

    task_id: str
    stage_uri: str
    log: StateLog
    completed: int = 0
    failed: int = 0
    total: int = 0
    suspended: bool = False
    errors: list[str] = field(default_factory=list)


# What Spark says when machines fail rather than data.
_LOST_MACHINES = (
    "ExecutorLostFailure", "FetchFailed", "SparkContext was shut down", "SparkContext is stopped",
    "cancelled because SparkContext", "No space left on device", "Connection refused", "has been shutdown",
)


def machines_failed(problem: BaseException) -> bool:
    """Whether a job failed for reasons that no choice of items mends, so that isolating items is pointless."""
    return not isinstance(problem, (PySparkException, Py4JJavaError, ValueError, RuntimeError)) or any(
        sign in str(problem) for sign in _LOST_MACHINES
    )


def new_task_id(operation: str, *names: str) -> str:
    """A run's name: its operation, what it is about and when it began; the last digits keep runs of one second apart."""
    title = run_title(RUN_PREFIX, operation, list(names), datetime.now(timezone.utc))
    return f"{title}_{uuid.uuid4().hex[:8].upper()}"


def key_struct(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(quoted(k)) for k in keys]).alias("part_key")


def key_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    missing = [k for k in keys if k not in df.columns]
    if not keys or missing:
        raise ValueError(f"partition keys not in the table: {', '.join(missing) or 'none given'}")
    return T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys])


def open_partition_log(spark: SparkSession, log_uri: str, df: DataFrame, keys: Sequence[str]) -> StateLog:
    return partition_log(spark, f"{log_uri}/partitions", key_schema(df, keys))


def analyse_partitions(
    df: DataFrame,
    keys: Sequence[str],
    log: StateLog,
    task_id: str,
    measure_bytes: bool = False,
    initial: str = "NOT_SELECTED",
) -> DataFrame:
    """Profile the table and add the partitions the log does not know yet.

    Returns the written profile ``(part_key, total_rows, input_bytes)``. By default a row weighs what its file does
    on average, as only the key columns are read; so a key of wide rows that lies in files of its own is weighed
    right, and an export corrects the others by what it has written. Measured, or where files' sizes are unknown,
    bytes are summed from every column. Known partitions keep their state and folder; new ones start as ``initial``.
    """
    size = None if measure_bytes else scanned_bytes(df)
    # grouped by the key as one value, so no key column can clash with a counter's name
    if size is not None and _is_scan(df):
        counts = _weighed_by_file(df, keys)
    else:
        weighed = F.lit(None) if size is not None else row_bytes(df.schema)
        counts = df.select(key_struct(keys), weighed.alias("bytes")).groupBy("part_key").agg(
            F.count(F.lit(1)).alias("total_rows"), F.sum(F.col("bytes").cast("bigint")).alias("input_bytes")
        )
    profile = materialize(counts, f"{log.uri}/profiles/{task_id}")
    if size is not None and not _is_scan(df):
        per_row = size / max(1, profile.agg(F.sum("total_rows")).first()[0] or 0)
        profile = profile.withColumn("input_bytes", F.ceil(F.col("total_rows") * F.lit(per_row)).cast("bigint"))

    known = log.current()
    unseen = new_partitions(profile, known.select("part_key"), ["part_key"]) if log.exists() else profile
    named = assign_path_keys(unseen, known.select("path_key"), keys, "part_key")
    log.append(
        named.select(
            "part_key", "base_key", "path_key", "total_rows", "input_bytes",
            F.lit(initial).alias("status"),
            F.lit(task_id).alias("task_id"),
            F.lit(0).alias("retry_count"),
            *[F.lit(None).alias(c) for c in (
                "rows_unloaded", "output_bytes", "file_count", "error_message", "started_at", "ended_at",
                "generation", "staged_files")],
        ),
        "analysed",
    )
    return profile


def _is_scan(df: DataFrame) -> bool:
    """Whether rows can be told by their place in a source file."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def _weighed_by_file(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(part_key, total_rows, input_bytes)``, a file's size shared out over its rows.

    Counts are combined per key and file before the shuffle: what moves is one row per key and task, as with keys
    alone, since a task reads few files.
    """
    rows = df.select(key_struct(keys), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    counts = rows.groupBy("part_key", "file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    share = F.col("size") * F.col("rows") / F.sum("rows").over(Window.partitionBy("file"))
    return counts.withColumn("share", share).groupBy("part_key").agg(
        F.sum("rows").alias("total_rows"), F.ceil(F.sum("share")).cast("bigint").alias("input_bytes")
    )


def select_partitions(log: StateLog, selection: DataFrame | Column | None = None, event: str = "selected") -> None:
    """Mark partitions PENDING: those whose key is in ``selection``, those a
    predicate over the log holds for, or all that are not completed."""
    state = log.current()
    if selection is None:
        chosen = as_pending(not_completed(state))
    elif isinstance(selection, Column):
        chosen = as_pending(state.filter(selection))
    else:
        typed = [F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in log.schema["part_key"].dataType]
        chosen = selected_as_pending(state, selection.select(F.struct(*typed).alias("part_key")).distinct(), ["part_key"])
    log.transition(chosen, event, rows_unloaded=F.lit(None))


def retry_failed(log: StateLog) -> None:
    """Make the failed items of a log PENDING again, for the next run to take up; retry counts stay."""
    log.transition(failed_as_pending(log.current()), "reset")


def _row_identity(df: DataFrame) -> Column:
    """A hash that spreads rows evenly and comes out the same when a task is rerun.

    Position in the source file where the table is a file scan: identical copies
    of a row then still spread. Otherwise the row's content.
    """
    if _is_scan(df):
        return F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return F.xxhash64(*[F.to_json(F.struct(F.col(quoted(f.name)))) if isinstance(f.dataType, (T.MapType, T.VariantType))
                        else F.col(quoted(f.name)) for f in df.schema])


def checked_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    """The columns to export, after a look at their names."""
    clash = [c for c in _RESERVED if c in df.columns]
    if clash:
        raise ValueError(f"column names reserved by the export: {', '.join(clash)}")
    return select_columns(df, columns).columns


def distribute(
    df: DataFrame,
    keys: Sequence[str],
    plan: DataFrame,
    columns: Sequence[str] | None = None,
    single_file: bool = True,
    restricted: bool = True,
    renamed: int | None = None,
    split: int | None = None,
    splitters_uri: str | None = None,
    weigh_all: bool = False,
    own_task: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Rows of the planned partitions, projected for Parquet and placed for the write.

    ``single_file`` brings a partition together in one task, and so in one file,
    unless the plan gives it several files because one would pass the size cap;
    its rows are then dealt out over that many tasks. Otherwise a rebalance lets
    AQE merge small partitions and split large ones by what the shuffle weighs.

    Partitions of ``own_task`` bytes or more have a task of their own, so no two of them meet in one; the others are
    hashed to ``tasks``, at most one each.

    Dealing is by a row's hash where a file takes so many rows that chance evens out their sizes, else by running
    bytes (``_splitters``), which are written to ``splitters_uri``; ``weigh_all`` asks for the latter throughout.

    A caller that knows its plan may spare work: ``restricted=False`` if no key of the
    table is left out; ``renamed`` and ``split``, how many folders are not named after their
    key alone and how many partitions have several files.
    """
    exported = checked_columns(df, columns)
    if not single_file:
        split = 0
    rows = df.withColumn(_ROW, _row_identity(df)) if split != 0 else df
    if restricted:
        rows = restrict_to_keys(rows, plan.select("part_key.*"), keys)

    wanted = T.StructType([df.schema[c] for c in exported])
    projected = [*compat_columns(wanted), base_path_key(df.schema, keys).alias("path_key")]
    placed = single_file and (split != 0 or own_task is not None)
    if renamed != 0 or placed:
        projected.append(key_struct(keys))
    if placed:
        projected.append(F.col(_ROW) if split != 0 else F.lit(0).cast("bigint").alias(_ROW))
    rows = rows.select(*projected)

    # both lookups hold exceptions only: colliding names, and partitions beyond the size
    # cap (at most table size / cap rows); Spark broadcasts them while they are small
    if renamed != 0:
        names = plan.filter("path_key <> base_key").select("part_key", F.col("path_key").alias("__name"))
        rows = rows.join(names, "part_key", "left").withColumn("path_key", F.coalesce("__name", "path_key"))
    if placed:
        rows = _deal_out(rows, plan, exported, splitters_uri, weigh_all, own_task, tasks)
    elif single_file:
        rows = rows.repartition("path_key")
    else:
        rows = rows.hint("rebalance", "path_key")
    return rows.select(*[F.col(quoted(c)) for c in exported], "path_key")


def _splitters(rows: DataFrame, several: DataFrame, exported: Sequence[str]) -> DataFrame:
    """Per part_key and grain of a split partition the file that takes it.

    A partition's rows fall into ``_GRAINS`` grains per file by their hash. The grains' bytes are summed over all
    rows, and a grain goes to the file in which the middle of its bytes lies in the running sum; so files differ by
    one grain, however wide single rows are. There are as many grains as files allow, not as rows.
    """
    size = row_bytes(T.StructType([rows.schema[c] for c in exported]))
    grains = rows.join(several, "part_key").withColumn(_GRAIN, _grain())
    weights = grains.groupBy("part_key", _GRAIN, "file_count").agg(F.sum(size).alias("weight"))
    of_key = Window.partitionBy("part_key")
    running = F.sum("weight").over(of_key.orderBy(_GRAIN).rowsBetween(Window.unboundedPreceding, 0))
    middle = (running - F.col("weight") / 2) / F.greatest(F.sum("weight").over(of_key), F.lit(1))
    file = F.least(F.floor(middle * F.col("file_count")), F.col("file_count") - 1)
    return weights.select("part_key", _GRAIN, file.cast("bigint").alias(_FILE))


def _grain() -> Column:
    return F.pmod(F.col(_ROW), F.col("file_count") * _GRAINS)


def _deal_out(
    rows: DataFrame,
    plan: DataFrame,
    exported: Sequence[str],
    splitters_uri: str | None,
    weigh_all: bool,
    own_task: int | None,
    tasks: int | None,
) -> DataFrame:
    """One task per planned file of a partition that is large or has several files; the rest share tasks by hash.

    Hashing partition and file number together would now and then bring two large files into one task.
    """
    several = F.col("file_count") > 1
    apart = several if own_task is None else several | (F.col("input_bytes") >= own_task)
    facts = plan.agg(
        F.count_if(~apart).alias("small"), F.sum(F.when(apart, F.col("file_count"))).alias("files"),
        F.count_if(several & (F.lit(weigh_all) | (F.col("total_rows") < F.col("file_count") * _EVEN_ROWS))).alias("weighed"),
    ).first()
    before = Window.orderBy("part_key").rowsBetween(Window.unboundedPreceding, -1)
    # a bounded number of large partitions and at most table size / size cap files, so one task may add them up
    offsets = plan.filter(apart).select(
        "part_key", "file_count", F.coalesce(F.sum("file_count").over(before), F.lit(0)).alias(_FIRST)
    )
    # those of several files through which chance does not spread bytes evenly
    uneven = plan.filter(several) if weigh_all else plan.filter(several & (F.col("total_rows") < F.col("file_count") * _EVEN_ROWS))
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = min(tasks, facts.small)
    joined = rows.join(offsets, "part_key", "left").withColumn(_GRAIN, _grain())
    file = F.pmod(F.col(_ROW), F.col("file_count"))
    if facts.weighed:
        splitters = _splitters(rows, uneven.select("part_key", "file_count"), exported)
        if splitters_uri:
            splitters = materialize(splitters, splitters_uri)
        joined = joined.join(splitters, ["part_key", _GRAIN], "left")
        file = F.coalesce(_FILE, file)
    own = F.lit(shared) + F.col(_FIRST) + file
    task = F.when(F.col(_FIRST).isNotNull(), own).otherwise(F.pmod(F.xxhash64("path_key"), F.lit(max(1, shared))))
    return joined.repartitionById(max(1, shared + int(facts.files or 0)), task.cast("int"))


def write_partitions(rows: DataFrame, stage_uri: str, max_records_per_file: int) -> None:
    """Add files to the folders that ``rows`` has partitions for.

    Earlier files stay until the new ones are told; so the write is a plain one, which every committer supports,
    and moves no folder in the driver.
    """
    (
        rows.write.mode("append")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("path_key")
        .parquet(stage_uri)
    )


def read_staged(spark: SparkSession, stage_uri: str, schema: T.StructType) -> DataFrame:
    """Staged rows with their ``path_key`` as text, whatever it looks like."""
    full = T.StructType([*schema, T.StructField("path_key", T.StringType())])
    return spark.read.schema(full).parquet(literal_path(stage_uri))


_STAGED = "path_key string, path string, rows bigint, size bigint, problem string"


def staged_files(folders: DataFrame, stage_uri: str) -> DataFrame:
    """Files of the named folders with their rows, told by footers; ``folders`` has a ``path_key``.

    Tasks look the folders up by name, so neither the driver nor any task lists the stage, and
    counting costs one footer per file whatever it holds.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for key in batch["path_key"]:
                filesystem, folder = open_file(f"{stage_uri}/path_key={key}")
                try:
                    infos = filesystem.get_file_info(pa_fs.FileSelector(folder, allow_not_found=True, recursive=True))
                except OSError as refused:
                    if refused.errno != errno.ENAMETOOLONG:  # such a folder cannot exist
                        raise
                    infos = []
                for info in infos:
                    if not info.is_file or info.base_name.startswith(("_", ".")):
                        continue
                    rows, problem = None, None
                    try:
                        with filesystem.open_input_file(info.path) as file:
                            rows = pq.read_metadata(file).num_rows
                    except pa.ArrowInvalid as unreadable:
                        problem = f"{info.base_name}: {unreadable}"
                    found.append((key, f"{stage_uri}/path_key={key}{info.path[len(folder):]}", rows, info.size, problem))
            yield pd.DataFrame(found, columns=["path_key", "path", "rows", "size", "problem"]).astype(
                {"rows": "Int64", "size": "Int64"}
            )

    return spread(folders.select("path_key")).mapInPandas(look, _STAGED)


def per_folder(files: DataFrame) -> DataFrame:
    """Rows, files and bytes per folder of ``staged_files``."""
    return files.groupBy("path_key").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"),
        F.max("size").alias("largest"), F.max("problem").alias("unreadable"),
        F.sort_array(F.collect_list(F.regexp_extract("path", "([^/]*)$", 1))).alias("names"),
    )


def staged_counts(spark: SparkSession, stage_uri: str) -> DataFrame:
    """Rows, files and bytes per folder of a whole stage, read from footers alone (no column is decoded)."""
    if not path_exists(spark, stage_uri):
        return spark.createDataFrame([], "path_key string, rows bigint, files bigint, bytes bigint")
    reader = spark.read.schema("path_key string").option("basePath", stage_uri)
    per_file = (
        reader.parquet(literal_path(stage_uri))
        .groupBy("path_key", F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("size"))
    )
    return per_file.groupBy("path_key").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


def export_pending(
    df: DataFrame,
    keys: Sequence[str],
    stage_uri: str,
    log: StateLog,
    profile: DataFrame,
    task_id: str,
    *,
    columns: Sequence[str] | None = None,
    overwrite: bool = True,
    single_file: bool = True,
    max_file_size: int = MAX_FILE_SIZE,
    wave_size: int | None = None,
    suspended: Callable[[], bool] = lambda: False,
    new_stage: bool = False,
    report: Callable[[ExportRun], None] = lambda run: None,
) -> ExportRun:
    """Export every PENDING partition, and those a crashed run left IN_PROGRESS.

    New files are written beside what a folder holds (nothing, in a ``new_stage``). Once they are counted and within the
    cap, the files they replace are removed by the tasks and the partition is settled, which publishes the new
    ones to importers by name. Of a partition that fails the new files are removed, and the earlier ones stay published.
    """
    spark = df.sparkSession
    run = ExportRun(task_id, stage_uri, log)
    open_items = with_status(log.current(), "PENDING", "IN_PROGRESS").drop("total_rows", "input_bytes", "event", "at", "seq")
    sized = open_items.join(profile, "part_key", "left").withColumn(
        "total_rows", F.coalesce("total_rows", F.lit(0).cast("bigint"))
    )
    sized = sized.withColumn("file_count", file_count(F.coalesce("input_bytes", F.lit(0)), max_file_size, _HEADROOM))
    # a count of the written profile reads footers only
    profiled = profile.count()
    ordered = with_rank(sized, ["total_rows", "part_key"], f"{log.uri}/plans/{task_id}-ranges")
    plan = materialize(ordered, f"{log.uri}/plans/{task_id}")
    facts = plan.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("total_rows") > 0).alias("filled"),
        F.max(F.col("input_bytes") / F.col("total_rows")).alias("widest"),
        F.max(F.when(F.col("file_count") == 1, F.col("total_rows"))).alias("longest"),
        F.count_if(F.col("path_key") != F.col("base_key")).alias("renamed"),
        F.count_if(F.col("file_count") > 1).alias("split"),
        F.sum("input_bytes").alias("bytes"), F.max("input_bytes").alias("heaviest"),
    ).first()
    run.total = facts.n
    if not facts.n:
        return run
    # the cap in rows holds for the partition with the widest rows, but
    # must not cut a partition that was found to fit into its single file
    max_records = rows_per_file(facts.widest or 1.0, max_file_size if single_file else int(max_file_size * _HEADROOM))
    if single_file:
        max_records = max(max_records, facts.longest or 1)
    # the source is a snapshot: when every profiled key is open, no filter is needed
    restricted = facts.filled < profiled
    waves = wave_ranges(facts.n, wave_size)
    waved = len(waves) > 1
    # tasks by what there is to write; a partition of half a task's share or more is not put with others by chance
    share = (facts.bytes or 0) // len(waves)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-share // _TASK_BYTES))
    own_task = max(_OWN_BYTES, share // (2 * tasks))
    if not single_file or (facts.heaviest or 0) < own_task or len(plan.filter(F.col("input_bytes") >= own_task).take(2)) < 2:
        own_task = None
    shape = {"renamed": facts.renamed, "split": facts.split, "own_task": own_task, "tasks": tasks}


    def export_range(
        lo: int, hi: int, part: DataFrame, done: list[tuple[int, int]], bad: list[tuple[int, int, str]], probed: bool = False
    ) -> None:
        """Write a slot range; ranges written go to ``done``, single partitions that cannot be to ``bad``.

        When the write fails, partitions whose rows cannot be computed are told by reading them, and the others
        are written together. Halves are tried only where nothing but the write itself fails.
        """
        narrowed = waved or probed or (lo, hi) != waves[0]
        try:
            rows = distribute(
                df, keys, part, columns, single_file, restricted or narrowed, **shape,
                splitters_uri=f"{log.uri}/plans/{task_id}-splitters-{lo}-{hi}",
            )
            write_partitions(rows, stage_uri, max_records)
            done.append((lo, hi))
            return
        except Exception as problem:
            if machines_failed(problem):
                raise
            if hi - lo <= 1:
                bad.append((lo, hi, str(problem)[:ERROR_LIMIT]))
                return
        if not probed:
            failing = failing_partitions(df, keys, part, columns, lo, hi)
            if failing:
                bad += [(slot, slot + 1, text) for slot, text in failing]
                part = materialize(
                    part.join(_errors(spark, bad), "slot", "left_anti"), f"{log.uri}/plans/{task_id}-sound-{lo}"
                )
                edges = [lo - 1, *[slot for slot, _ in failing], hi]
                sound: list[tuple[int, int]] = []
                if part.take(1):
                    export_range(lo, hi, part, sound, bad, probed=True)
                for first, after in sound:
                    gaps = zip(edges, edges[1:])
                    done += [(max(a + 1, first), min(b, after)) for a, b in gaps if max(a + 1, first) < min(b, after)]
                return
        middle = (lo + hi) // 2
        for a, b in ((lo, middle), (middle, hi)):
            half = part.filter((F.col("slot") >= a) & (F.col("slot") < b))
            if half.take(1):
                export_range(a, b, half, done, bad, probed=True)

    def fitted(wave: DataFrame, earlier: DataFrame | None, lo: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """What the run wrote to the wave's folders, after those whose estimate was wrong were written again.

        A partition with a file beyond the cap, or split though one file would have held it, is written
        again by what it was found to weigh, its rows dealt out by running bytes; if a file is beyond the cap still,
        with more files. A partition that no number of files brings below the cap has ``beyond`` set. Returns the
        folders, the files they now consist of, and the files those replace.
        """
        headroom, beyond, replaced = _HEADROOM, F.col("largest") > max_file_size, earlier
        for number in range(_REWRITES + 1):
            files = listed(wave, f"written-files-{number}", lo)
            if replaced is not None:
                files = materialize(
                    files.join(replaced.select("path"), "path", "left_anti"), f"{log.uri}/plans/{task_id}-own-files-{lo}-{number}"
                )
            held = per_folder(files).withColumn("beyond", beyond)
            # one file, one row: nothing is left to split
            again = beyond & (F.col("files") < F.col("rows"))
            if single_file and not number:
                again |= (F.col("files") > 1) & (F.col("bytes") <= max_file_size)
            misjudged = held.filter(again)
            if number == _REWRITES or misjudged.isEmpty():
                break
            outdated = files.join(misjudged.select("path_key"), "path_key", "left_semi")
            replaced = outdated if replaced is None else replaced.unionByName(outdated)
            wrong = wave.drop("file_count", "total_rows").join(misjudged, "path_key")
            wrong = wrong.withColumns({"file_count": file_count(F.col("bytes"), max_file_size, headroom), "total_rows": F.col("rows")})
            wrong = materialize(wrong.select(wave.columns), f"{log.uri}/plans/{task_id}-wrong-{lo}-{number}")
            rows = distribute(
                df, keys, wrong, columns, True, True, renamed=facts.renamed, weigh_all=True,
                splitters_uri=f"{log.uri}/plans/{task_id}-splitters-{lo}-{number}",
            )
            write_partitions(rows, stage_uri, 0)
            headroom *= 0.75
        return held, files, replaced

    def listed(wave: DataFrame, moment: str, lo: int) -> DataFrame:
        """The files of a wave's folders, written down once."""
        return materialize(staged_files(wave, stage_uri), f"{log.uri}/plans/{task_id}-{moment}-{lo}")

    for lo, hi in waves:
        if lo and suspended():
            run.suspended = True
            break
        wave = plan.filter((F.col("slot") >= lo) & (F.col("slot") < hi)) if waved else plan
        earlier = None if new_stage else listed(wave, "present", lo)
        if not overwrite and earlier is not None:
            present = earlier.select("path_key").distinct()
            # a partition that was begun and never settled may replace what it left behind
            refused = wave.join(present, "path_key", "left_semi").filter(~_begun())
            wave = wave.join(refused.select("path_key"), "path_key", "left_anti")
            refused = materialize(refused, f"{log.uri}/plans/{task_id}-refused-{lo}")
            wave = materialize(wave, f"{log.uri}/plans/{task_id}-wave-{lo}")
            log.transition(
                refused, "refused",
                status=F.lit("FAILED"), task_id=F.lit(task_id), ended_at=F.current_timestamp(),
                error_message=F.lit("files already exist in the partition's folder and overwrite is off"),
            )
            run.failed += refused.count()
        started = F.lit(datetime.now(timezone.utc))
        log.transition(
            wave, "started",
            status=F.lit("IN_PROGRESS"), task_id=F.lit(task_id), started_at=started,
            ended_at=F.lit(None), rows_unloaded=F.lit(None),
        )
        # partitions that lost all their rows since they were analysed have nothing to write
        filled = wave.filter("total_rows > 0") if facts.filled < facts.n else wave
        done: list[tuple[int, int]] = []
        bad: list[tuple[int, int, str]] = []
        broken = None
        if facts.filled == facts.n and overwrite or filled.take(1):
            try:
                export_range(lo, hi, filled, done, bad)
            except Exception as problem:
                broken = problem
        if broken is not None:
            # settle what was finished before the machines failed; the rest stays in progress for a later run
            if not done and not bad:
                raise broken
            wave = wave.join(_slots(spark, done + [b[:2] for b in bad]), "slot", "left_semi")

        error = _errors(spark, bad)
        held, files, replaced = fitted(filled.join(_slots(spark, done), "slot", "left_semi") if bad or broken else filled, earlier, lo)
        settled = wave.join(held, "path_key", "left").join(error, "slot", "left")
        missing = F.when((F.col("total_rows") > 0) & F.col("files").isNull(), F.lit("no files of the partition are staged"))
        too_large = F.when(F.col("beyond"), F.concat(
            F.lit("a file of "), "largest", F.lit(f" bytes is beyond the cap of {max_file_size}, in "), "files", F.lit(" files")
        ))
        settled = settled.withColumn("problem", F.coalesce("failure", "unreadable", missing, too_large))
        settled = materialize(settled, f"{log.uri}/plans/{task_id}-settled-{lo}")
        outcome = _outcome(settled)
        if outcome.bad or replaced is not None:
            # the files that are replaced go, and those of partitions that failed; an emptied partition is replaced by nothing
            outdated = files.join(settled.filter("problem is not null").select("path_key"), "path_key", "left_semi")
            if replaced is not None:
                sound = settled.filter("problem is null").select("path_key")
                outdated = outdated.unionByName(replaced.join(sound, "path_key", "left_semi"))
            gone = materialize(remove_files(outdated.select("path"), confirm=True), f"{log.uri}/plans/{task_id}-removed-{lo}")
            stuck = gone.filter("problem is not null").select(
                F.regexp_extract("path", "/path_key=([^/]*)/", 1).alias("path_key"), F.col("problem").alias("stale")
            ).groupBy("path_key").agg(F.first("stale").alias("stale"))
            settled = settled.join(stuck, "path_key", "left").withColumn("problem", F.coalesce("problem", "stale"))
            outcome = _outcome(settled)
        ok = F.col("problem").isNull()
        written = ok & (F.col("total_rows") > 0)
        nothing = F.lit(0).cast("bigint")
        log.transition(
            settled, "settled",
            status=F.when(ok, "COMPLETED").otherwise("FAILED"),
            task_id=F.lit(task_id),
            started_at=started,
            ended_at=F.current_timestamp(),
            rows_unloaded=F.when(ok, F.when(written, F.coalesce("rows", nothing)).otherwise(nothing)),
            output_bytes=F.when(written, F.col("bytes")),
            file_count=F.when(written, F.col("files")),
            retry_count=F.when(ok, F.col("retry_count")).otherwise(F.col("retry_count") + 1),
            error_message=F.col("problem"),
            # what importers may take: the files of this run, all of them or none
            generation=F.when(ok, F.lit(task_id)).otherwise(F.col("generation")),
            staged_files=F.when(written, F.col("names")).when(ok, F.array()).otherwise(F.col("staged_files")),
        )
        run.errors += [text for _, _, text in bad]
        run.failed += outcome.bad
        run.completed += outcome.n - outcome.bad
        if broken is not None:
            raise broken
        if waved:
            report(run)
    return run


def failing_partitions(
    df: DataFrame, keys: Sequence[str], part: DataFrame, columns: Sequence[str] | None, lo: int, hi: int
) -> list[tuple[int, str]]:
    """``(slot, text)`` of the partitions in a slot range whose rows cannot be computed, by slot.

    Ranges are read, not written: one stage each without a shuffle, the keys as filters of the scan, ``_PROBES`` at a
    time. A range that fails is read again in ``_PROBES`` parts.
    """
    wanted = T.StructType([df.schema[c] for c in checked_columns(df, columns)])
    named = _NAMED if all(isinstance(df.schema[k].dataType, LITERAL_TYPES) for k in keys) else 0

    def failure(span: tuple[int, int]) -> str | None:
        chosen = part.filter((F.col("slot") >= span[0]) & (F.col("slot") < span[1])).select("part_key")
        few = chosen.collect() if span[1] - span[0] <= named else None  # at most as many rows
        if few == []:
            return None
        if few:
            any_of = reduce(Column.__or__, [partition_predicate(r.part_key.asDict(), df.schema) for r in few])
            rows = df.filter(any_of)
        else:
            rows = restrict_to_keys(df, chosen.select("part_key.*"), keys)
        try:
            rows.select(*compat_columns(wanted)).write.format("noop").mode("overwrite").save()
        except Exception as problem:
            if machines_failed(problem):
                raise
            return str(problem)[:ERROR_LIMIT]
        return None

    failing, pending = [], [(lo, hi)]
    with ThreadPoolExecutor(_PROBES) as pool:
        while pending:
            spans = []
            for first, after in pending:
                width = -(-(after - first) // _PROBES)
                spans += [(a, min(a + width, after)) for a in range(first, after, width)]
            found = [(span, text) for span, text in zip(spans, pool.map(failure, spans), strict=True) if text is not None]
            failing += [(a, text) for (a, b), text in found if b - a == 1]
            pending = [span for span, _ in found if span[1] - span[0] > 1]
    return sorted(failing)


_EXPORTS = "_exports"  # in a stage: which logs tell what its folders hold


def announce(spark: SparkSession, stage_uri: str, log_uri: str) -> None:
    """Tell importers of the stage where its log is."""
    name = hashlib.sha256(qualify(spark, log_uri).encode()).hexdigest()[:16]
    mark = f"{stage_uri.rstrip('/')}/{_EXPORTS}/{name}"
    if not path_exists(spark, mark):
        write_text(spark, mark, qualify(spark, log_uri))


def exported_folders(spark: SparkSession, stage_uri: str) -> DataFrame | None:
    """``(path_key, state, generation, staged_files)`` of the stage's folders as their logs have them.

    ``generation`` names the run that wrote ``staged_files``, all of a folder's files at once. ``None`` if no export
    wrote here. Of a folder that several logs know the last one written counts.
    """
    marks = f"{stage_uri.rstrip('/')}/{_EXPORTS}"
    if not path_exists(spark, marks):
        return None
    known = []
    # one line per log that ever exported to this stage
    for line in spark.read.text(literal_path(marks)).collect():
        columns = "path_key string, status string, started_at timestamp, generation string, staged_files array<string>"
        log = StateLog(spark, f"{line.value}/partitions", T.StructType.fromDDL(columns), ["path_key"])
        known.append(log.current().select("path_key", F.col("status").alias("state"), "started_at", "generation", "staged_files"))
    folders = reduce(DataFrame.unionByName, known).filter("generation is not null or state in ('IN_PROGRESS', 'FAILED')")
    return folders.groupBy("path_key").agg(
        *[F.max_by(c, "started_at").alias(c) for c in ("state", "generation", "staged_files")]
    )


def _outcome(settled: DataFrame):
    return settled.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("problem").isNotNull()).alias("bad")).first()


def _begun() -> Column:
    """Whether an earlier run started the partition and never settled it."""
    return F.col("started_at").isNotNull() & F.col("ended_at").isNull()


def _slots(spark: SparkSession, ranges: list[tuple[int, int]]) -> DataFrame:
    """The slots of some ranges."""
    spans = spark.createDataFrame(ranges, "first bigint, after bigint")
    return spans.select(F.explode(F.sequence("first", F.col("after") - 1)).alias("slot"))


def _errors(spark: SparkSession, bad: list[tuple[int, int, str]]) -> DataFrame:
    """``(slot, failure)`` of the partitions that could not be written."""
    return spark.createDataFrame([(a, text) for a, _, text in bad], "slot bigint, failure string")


def record_run(runs: StateLog, task_id: str, operation: str, status: str, **values) -> None:
    """Append one state of a run to the registry; ``values`` may tell when it was created and started."""
    row = one_row(runs.spark, task_id=task_id, operation=operation, status=status, **values)
    missing = [f for f in runs.schema if f.name not in row.columns]
    now = F.current_timestamp()
    stamps = {
        "created_at": now,
        "started_at": now if status == "RUNNING" else F.lit(None),
        "ended_at": now if status in ("COMPLETED", "FAILED") else F.lit(None),
    }
    runs.append(
        row.select("*", *[stamps.get(f.name, F.lit(None)).alias(f.name) for f in missing]), status
    )


def refuse_concurrent(runs: StateLog, takeover: bool, own: str | None = None) -> None:
    """Logs have one writer at a time, and two runs on one stage would overwrite each other's folders.

    The run named ``own`` is this one, begun before and taken up again.
    """
    if takeover or not runs.exists():
        return
    runs.refresh()
    busy = with_status(runs.current(), "RUNNING").filter(~F.col("task_id").eqNullSafe(F.lit(own))).select("task_id", "stage_uri").take(1)
    if busy:
        raise RuntimeError(
            f"run {busy[0].task_id} is still RUNNING on {busy[0].stage_uri}; "
            "pass takeover=True once it is known to be dead"
        )


def _suspension(runs: StateLog, task_id: str) -> str:
    return f"{runs.uri}/suspend/task_id={task_id}"


def suspend_run(runs: StateLog, task_id: str) -> None:
    """Ask a run to stop before its next wave; what is left stays PENDING for a later call."""
    # a mark beside the log: the log itself belongs to the run
    one_row(runs.spark, task_id=task_id).write.mode("overwrite").parquet(_suspension(runs, task_id))


def is_suspended(runs: StateLog, task_id: str) -> bool:
    return path_exists(runs.spark, _suspension(runs, task_id))


def refuse_reuse(runs: StateLog, task_id: str | None) -> None:
    """A run's name marks the folders it writes, so no second run may carry it."""
    if task_id is not None and runs.exists():
        if runs.current().filter(F.col("task_id") == task_id).take(1):
            raise ValueError(f"a run named {task_id} exists already")


def finished_before(runs: StateLog, task_id: str) -> bool:
    """Whether a run of this name has completed already."""
    return runs.exists() and bool(with_status(runs.current(), "COMPLETED").filter(F.col("task_id") == task_id).take(1))


def export_table(
    df: DataFrame,
    keys: Sequence[str],
    stage_uri: str,
    *,
    log_uri: str,
    columns: Sequence[str] | None = None,
    selection: DataFrame | Column | None = None,
    overwrite: bool = True,
    single_file: bool = True,
    max_file_size: int = MAX_FILE_SIZE,
    wave_size: int | None = None,
    log_mode: str = "reuse",
    measure_bytes: bool = False,
    source: str = "",
    task_id: str | None = None,
    takeover: bool = False,
) -> ExportRun:
    """Analyse, select and export in one call; call again to resume or to add new partitions."""
    if log_mode not in ("reuse", "fresh"):
        raise ValueError("log_mode is 'reuse' or 'fresh'")
    if not 0 < max_file_size <= MAX_FILE_SIZE:
        raise ValueError(f"max_file_size must be between 1 and {MAX_FILE_SIZE} bytes")
    checked_columns(df, columns)
    log = open_partition_log(df.sparkSession, log_uri, df, keys)
    spark = df.sparkSession
    new_stage = not path_exists(spark, stage_uri)
    runs = run_log(spark, f"{log_uri}/runs")
    refuse_reuse(runs, task_id)
    task_id = task_id or new_task_id("export", source or stage_uri.rstrip("/").rsplit("/", 1)[-1])
    refuse_concurrent(runs, takeover)
    facts = {
        "source": source,
        "stage_uri": stage_uri,
        "parameters": json.dumps(
            {
                "keys": list(keys),
                "columns": list(columns) if columns else None,
                "overwrite": overwrite,
                "single_file": single_file,
                "max_file_size": max_file_size,
                "wave_size": wave_size,
            }
        ),
    }
    began = datetime.now(timezone.utc)
    facts |= {"created_at": began, "started_at": began}

    def report(run: ExportRun, status: str = "RUNNING") -> None:
        record_run(
            runs, task_id, "EXPORT", status,
            total_items=run.total, completed_items=run.completed, failed_items=run.failed, **facts,
        )

    record_run(runs, task_id, "EXPORT", "RUNNING", **facts)
    try:
        announce(spark, stage_uri, log_uri)
        if log_mode == "fresh":
            log.start_fresh()
        # with nothing logged and nothing to choose, all partitions start out selected
        choose = selection is not None or log.exists()
        initial = "NOT_SELECTED" if choose else "PENDING"
        profile = analyse_partitions(df, keys, log, task_id, measure_bytes, initial)
        if choose:
            select_partitions(log, selection)
        run = export_pending(
            df, keys, stage_uri, log, profile, task_id,
            columns=columns, overwrite=overwrite, single_file=single_file,
            max_file_size=max_file_size, wave_size=wave_size,
            suspended=lambda: is_suspended(runs, task_id), new_stage=new_stage, report=report,
        )
    except Exception as problem:
        record_run(runs, task_id, "EXPORT", "FAILED", error_message=str(problem)[:ERROR_LIMIT], **facts)
        raise
    report(run, "SUSPENDED" if run.suspended else "COMPLETED")
    return run
