"""Import: bring staged Parquet files into a target table.

A wave of files is inspected once by its footers; the load mode of each file is
then a column, and each mode is one set-based job over its files. A wave
publishes its files with one log append, after their data is in place.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartage.functions.paths import relative_path
from cartage.functions.texts import ERROR_LIMIT, both_failed_message, clip_error, fallback_message
from cartage.functions.types import bind_by_name
from cartage.operators.export import (
    exported_folders,
    finished_before,
    is_suspended,
    machines_failed,
    new_task_id,
    record_run,
    refuse_concurrent,
    refuse_reuse,
)
from cartage.operators.logs import LOADED, REPLACED, StateLog, with_status
from cartage.operators.target import (
    ADD_FILES_COPY,
    ADD_FILES_REFERENCE,
    FULL_INGEST,
    LOAD_MODES,
    RESERVED_FOLDERS,
    Target,
)
from cartage.plans.work import wave_ranges, with_rank
from cartage.session import literal_path, materialize, qualify, session_setting
from cartage.sources.files import files_only, list_files, open_file, read_footers

_CHUNK = 8 * 1024 * 1024
_WAVE_FILES = 10_000

# Widest integer each decimal must hold to take a file's integer column unchanged.
_INTEGER_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


class StagedFile(NamedTuple):
    source_uri: str
    num_rows: int
    file_schema: str


@dataclass
class ImportRun:
    task_id: str
    target: Target
    completed: int = 0
    failed: int = 0
    fell_back: int = 0
    replaced: int = 0
    total: int = 0
    suspended: bool = False


def discover(
    listing: DataFrame, stage_uri: str, log: StateLog, stage_path: str = "", exported: DataFrame | None = None
) -> DataFrame:
    """Listed files, not empty, that the log does not know yet.

    A file is known by its path, so what appears in a folder whose loaded files were cleaned away is new data.
    ``exported`` tells what an export published: its files carry the ``generation`` of their folder, and files of a
    folder that is being exported or whose export failed are left out. ``replaces`` marks a generation whose folder
    has rows of an earlier one in the table.
    """
    staged = files_only(listing).select(
        F.col("path").alias("source_uri"),
        relative_path(F.col("path"), stage_path, stage_uri).alias("file_path"),
        "length",
    )
    if log.exists():
        staged = staged.join(log.current().select("source_uri"), "source_uri", "left_anti")
    if exported is None:
        return staged.withColumns({"generation": F.lit(None).cast("string"), "replaces": F.lit(False)})
    own = exported.withColumn("folder", _folder_uri(stage_uri)).drop("path_key")
    named = staged.withColumn("folder", folder_of("source_uri")).join(own, "folder", "left")
    published = F.array_contains("staged_files", F.regexp_extract("source_uri", "([^/]*)$", 1))
    named = named.withColumn("generation", F.when(published, F.col("generation")))
    named = named.filter(F.col("generation").isNotNull() | F.col("state").isNull() | (F.col("state") == "COMPLETED"))
    if not log.exists():
        return named.select(*staged.columns, "generation", F.lit(False).alias("replaces"))
    before = with_status(log.current(), "SUCCESS").filter("generation is not null")
    before = before.groupBy(folder_of("source_uri").alias("folder")).agg(F.max("generation").alias("earlier"))
    joined = named.join(before, "folder", "left")
    replaces = F.coalesce(F.col("earlier") != F.col("generation"), F.lit(False))
    return joined.select(*staged.columns, "generation", replaces.alias("replaces"))


def _folder_uri(stage_uri: str) -> Column:
    return F.concat(F.lit(f"{stage_uri.rstrip('/')}/path_key="), "path_key")


def enqueue(new_files: DataFrame, log: StateLog, task_id: str) -> None:
    """Log new files as PENDING."""
    log.append(
        new_files.select(
            "file_path", "source_uri", "length",
            F.lit("PENDING").alias("status"),
            F.lit(task_id).alias("task_id"),
            F.lit(0).alias("retry_count"),
            "generation", "replaces",
            *[F.lit(None).alias(c) for c in (
                "target_path", "load_mode_used", "rows_parsed", "rows_loaded", "error_message", "started_at", "ended_at")],
        ),
        "enqueued",
    )


def folder_of(path: str) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def publish_replacements(log: StateLog, stage_uri: str, exported: DataFrame, uri: str) -> int:
    """Swap generations: one append makes new files of a folder part of the table and retires those they replace.

    A folder is swapped once all files of its generation are loaded; until then the table keeps the earlier rows. A
    folder whose partition has become empty has no files to wait for. Returns how many files were retired.
    """
    state = log.current().withColumn("folder", folder_of("source_uri")).filter(F.col("status").isin("SUCCESS", LOADED))
    now = exported.filter("state = 'COMPLETED'").select(
        _folder_uri(stage_uri).alias("folder"), F.col("generation").alias("newest"), F.size("staged_files").alias("expected")
    )
    held = state.filter("generation is not null").join(now, "folder")
    ready = held.groupBy("folder", "newest", "expected").agg(
        F.count_if(F.col("generation") == F.col("newest")).alias("present"),
        F.count_if((F.col("generation") != F.col("newest")) | (F.col("status") == LOADED)).alias("changing"),
    )
    ready = ready.filter("present = expected and changing > 0").select("folder", "newest")
    changed = state.filter("generation is not null").join(ready, "folder")
    changed = changed.withColumn("now", F.when(F.col("generation") == F.col("newest"), "SUCCESS").otherwise(REPLACED))
    changed = materialize(changed.filter("now <> status"), uri)
    if changed.isEmpty():
        return 0
    log.transition(changed, "swapped", status=F.col("now"))
    return changed.filter(F.col("now") == REPLACED).count()


def copy_types(dt: T.DataType) -> list[str]:
    """File column types that a table column of type ``dt`` reads without rewriting."""
    same = dt.simpleString()
    if isinstance(dt, T.DecimalType):
        narrower = [f"decimal({p},{dt.scale})" for p in range(max(dt.scale, 1), dt.precision + 1)]
        whole = [t for t, digits in _INTEGER_DIGITS.items() if dt.precision - dt.scale >= digits]
        return narrower + whole
    wider = {
        "smallint": ["tinyint"],
        "int": ["tinyint", "smallint"],
        "bigint": ["tinyint", "smallint", "int"],
        "double": ["float"],
    }
    return [same, *wider.get(same, [])]


def _first_problem(columns: Column, test, message) -> Column:
    """Message for the first file column that ``test`` holds for, else NULL."""
    return F.get(F.transform(F.filter(columns, test), message), F.lit(0))


def physical_problem(schema: T.StructType, accepted: dict[str, list[str]]) -> Column:
    """Why a file cannot join the table as it is; NULL if it can. Works on footer rows."""
    columns = F.col("columns")
    # a map literal looked up per column keeps the whole check inside one expression
    known = F.create_map(*[x for n, ts in accepted.items() for x in (F.lit(n), F.array(*map(F.lit, ts)))])
    declared = F.create_map(*[x for f in schema for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    folded = F.create_map(*[x for f in schema.fields for x in (F.lit(f.name.lower()), F.lit(f.name))]) if len(
        {f.name.lower() for f in schema}
    ) == len(schema) else None

    def has(c):
        return F.map_contains_key(known, c["name"])

    def text(*parts):
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    checks = [
        F.col("error"),
        _first_problem(
            columns,
            lambda c: has(c) & c["unit"].isNotNull() & (c["unit"] != "MICROS"),
            lambda c: text("column ", c["name"], ": time unit ", c["unit"], " where the table needs MICROS"),
        ),
        _first_problem(
            columns,
            lambda c: has(c) & ~F.array_contains(F.element_at(known, c["name"]), c["type"]),
            lambda c: text("column ", c["name"], ": type ", c["type"], " in the file, ",
                           F.element_at(declared, c["name"]), " in the table"),
        ),
    ]
    if folded is not None:
        checks.append(
            _first_problem(
                columns,
                lambda c: ~has(c) & F.map_contains_key(folded, F.lower(c["name"])),
                lambda c: text("column ", c["name"], " differs from ",
                               F.element_at(folded, F.lower(c["name"])), " by case only"),
            )
        )
    return F.coalesce(*checks)


def location_problem(path: Column, base_uri: str) -> Column:
    """Why a file may not be registered in place."""
    base = base_uri.rstrip("/") + "/"
    problem = F.when(~F.startswith(path, F.lit(base)), F.lit(f"file is not under the table's base location {base}"))
    for folder in RESERVED_FOLDERS:
        problem = problem.when(
            F.startswith(path, F.lit(f"{base}{folder}/")), F.lit(f"{folder}/ under the base location is reserved")
        )
    return problem


def inspect_files(files: DataFrame, target: Target) -> DataFrame:
    """Footers of the files with a verdict per load mode (NULL means it will do)."""
    footers = read_footers(files.select(F.col("source_uri").alias("path"), "length"))
    copyable = {f.name: copy_types(f.dataType) for f in target.schema}
    exact = {f.name: [f.dataType.simpleString()] for f in target.schema}
    signature = F.array_join(
        F.transform("columns", lambda c: F.concat(F.lit("`"), F.replace(c["name"], F.lit("`"), F.lit("``")), F.lit("` "), c["type"])),
        ", ",
    )
    return footers.select(
        F.col("path").alias("source_uri"),
        "num_rows",
        "error",
        signature.alias("file_schema"),
        physical_problem(target.schema, copyable).alias("copy_problem"),
        F.coalesce(location_problem(F.col("path"), target.base_uri), physical_problem(target.schema, exact)).alias(
            "reference_problem"
        ),
    )


def read_bound(spark: SparkSession, file_schema: str, paths: list[str], schema: T.StructType) -> DataFrame:
    """Files of one physical schema, bound to the table's columns by exact name."""
    files = spark.read.schema(file_schema).option("recursiveFileLookup", "true")
    return bind_by_name(files.parquet(*[literal_path(p) for p in paths]), schema)


def ingest(files: list[StagedFile], target: Target, load_id: str) -> list[tuple]:
    """Rewrite files as one load; returns ``(source_uri, folder, problem)`` per file.

    All files go through one job, whatever number of physical schemas they have.
    If it fails, halves are tried until every file at fault stands alone; however many
    there are, each gets its own problem. Failing machines end the load instead.
    """
    spark = target.spark

    def problem_of(error: Exception) -> str:
        return str(error).strip().split("\n")[0][:ERROR_LIMIT]

    def attempt(part: list[StagedFile], name: str) -> list[tuple]:
        folder = target.load_folder(name)
        by_schema: dict[str, list[StagedFile]] = {}
        for row in part:
            by_schema.setdefault(row.file_schema, []).append(row)
        frames, refused, accepted = [], [], []
        for file_schema, rows in by_schema.items():
            try:
                frames.append(read_bound(spark, file_schema, [r.source_uri for r in rows], target.schema))
                accepted += rows
            except Exception as error:
                # no cast leads from this file schema to the table's, or a path vanished
                if isinstance(error, AnalysisException) or len(part) == 1:
                    refused += [(r.source_uri, None, problem_of(error)) for r in rows]
                else:
                    raise
        if not frames:
            return refused
        try:
            seen = Observation()
            loaded = reduce(DataFrame.union, frames).observe(seen, F.count(F.lit(1)).alias("rows"))
            loaded.write.mode("overwrite").parquet(folder)
            expected = sum(r.num_rows for r in accepted)
            if seen.get["rows"] != expected:
                raise RuntimeError(f"{seen.get['rows']} rows loaded where the footers promise {expected}")
            return refused + [(r.source_uri, folder, None) for r in accepted]
        except Exception as error:
            if machines_failed(error):
                raise
            if len(accepted) == 1:
                return refused + [(accepted[0].source_uri, None, problem_of(error))]
        middle = len(accepted) // 2
        return refused + attempt(accepted[:middle], f"{name}a") + attempt(accepted[middle:], f"{name}b")

    with session_setting(spark, "spark.sql.caseSensitive", "true"):
        return attempt(files, load_id)


def copy_files(files: DataFrame, folder: str) -> DataFrame:
    """Copy files byte for byte into ``folder``; one row per file with the error, if any.

    A copy gets a name derived from its source, so a rerun task replaces its own
    work. The table takes exactly the copies told here: what a failed attempt leaves
    in the folder, whole or not, is in no manifest.
    """

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import contextlib
        import hashlib
        import uuid

        for batch in batches:
            problems, copies = [], []
            for source, length in zip(batch["source_uri"], batch["length"]):
                name = hashlib.sha256(source.encode()).hexdigest()
                partial = None
                try:
                    from_fs, from_path = open_file(source)
                    to_fs, to_folder = open_file(folder)
                    to_fs.create_dir(to_folder, recursive=True)
                    final = f"{to_folder}/{name}.parquet"
                    # object stores show a file once it is complete; others need the rename
                    direct = to_fs.type_name not in ("local", "hdfs")
                    partial = final if direct else f"{to_folder}/_{name}.{uuid.uuid4().hex}"
                    written = 0
                    with from_fs.open_input_stream(from_path) as reader, to_fs.open_output_stream(partial) as writer:
                        while chunk := reader.read(_CHUNK):
                            writer.write(chunk)
                            written += len(chunk)
                    if written != length:
                        raise OSError(f"{written} bytes copied of {length}")
                    if not direct:
                        to_fs.move(partial, final)
                    problems.append(None)
                    copies.append(f"{folder}/{name}.parquet")
                except Exception as problem:
                    # closing the stream may have published what was written so far
                    if partial is not None:
                        with contextlib.suppress(Exception):
                            to_fs.delete_file(partial)
                    problems.append(f"{type(problem).__name__}: {problem}")
                    copies.append(None)
            yield pd.DataFrame({"source_uri": batch["source_uri"], "copy": copies, "problem": problems})

    # by length, so that each task gets some long and some short files
    tasks = files.sparkSession.sparkContext.defaultParallelism
    dealt = files.select("source_uri", "length").orderBy(F.desc("length"), "source_uri")
    dealt = dealt.withColumn("task", F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).cast("int"))
    return dealt.repartitionById(tasks, "task").select("source_uri", "length").mapInPandas(
        copy, "source_uri string, copy string, problem string"
    )


def _settle(log: StateLog, files: DataFrame, event: str, **changes: Column) -> None:
    log.transition(files, event, ended_at=F.current_timestamp(), **changes)


def _loaded() -> Column:
    """State of a file whose rows are in place: part of the table, unless it waits to replace others."""
    return F.when(F.coalesce("replaces", F.lit(False)), LOADED).otherwise("SUCCESS")


def import_wave(wave: DataFrame, target: Target, log: StateLog, load_mode: str, load_id: str) -> None:
    """Load one wave of pending files (rows of the file log)."""
    spark = target.spark
    started = F.lit(datetime.now(timezone.utc))
    task = F.lit(load_id.rsplit("-", 1)[0])
    log.transition(wave, "started", status=F.lit("IN_PROGRESS"), task_id=task, started_at=started)
    verdicts = materialize(inspect_files(wave, target), f"{log.uri}/inspections/{load_id}")
    known = wave.drop("started_at", "task_id").join(verdicts, "source_uri")
    known = known.withColumns({"started_at": started, "task_id": task})
    loaded = {"rows_parsed": F.col("num_rows"), "rows_loaded": F.col("num_rows")}
    nothing = {"rows_parsed": F.lit(None), "rows_loaded": F.lit(None)}

    if load_mode == ADD_FILES_REFERENCE:
        ok = F.col("reference_problem").isNull()
        _settle(
            log, known, "registered",
            status=F.when(ok, _loaded()).otherwise("FAILED"),
            load_mode_used=F.lit(ADD_FILES_REFERENCE),
            target_path=F.when(ok, F.col("source_uri")),
            rows_parsed=F.when(ok, F.col("num_rows")),
            rows_loaded=F.when(ok, F.col("num_rows")),
            error_message=clip_error(F.col("reference_problem")),
        )
        return

    fallback = load_mode == ADD_FILES_COPY
    todo = known
    if fallback:
        folder = target.load_folder(f"{load_id}-copy")
        fit = known.filter("copy_problem is null")
        copied = materialize(copy_files(fit, folder), f"{log.uri}/copies/{load_id}")
        judged = known.join(copied, "source_uri", "left").withColumn(
            "copy_problem", F.coalesce("copy_problem", "problem")
        )
        done = judged.filter("copy_problem is null")
        _settle(
            log, done, "copied",
            status=_loaded(), load_mode_used=F.lit(ADD_FILES_COPY), target_path=F.col("copy"),
            error_message=F.lit(None), **loaded,
        )
        todo = judged.filter("copy_problem is not null").withColumn(
            "error_message", fallback_message(F.col("copy_problem"))
        )
        if not todo.take(1):
            return
        todo = materialize(todo.drop("problem", "copy"), f"{log.uri}/inspections/{load_id}-retry")
        log.transition(todo, "retrying", status=F.lit("RETRYING_FULL_INGEST"))

    # at most a wave of file names, which Spark's reader needs; each schema comes once
    readable = todo.filter("error is null").groupBy("file_schema").agg(
        F.sort_array(F.collect_list(F.struct("source_uri", "num_rows"))).alias("files")
    )
    files = [StagedFile(f.source_uri, f.num_rows, g.file_schema) for g in readable.collect() for f in g.files]
    outcome = ingest(files, target, f"{load_id}-ingest") if files else []
    results = spark.createDataFrame(outcome, "source_uri string, folder string, problem string")
    # a file whose copy failed keeps that message when the ingest worked out
    problem = F.coalesce("error", "problem", F.when(F.col("folder").isNull(), F.lit("file was not loaded")))
    settled = todo.join(results, "source_uri", "left").withColumn("problem", problem)
    ok = F.col("problem").isNull()
    failure = both_failed_message(F.col("problem")) if fallback else clip_error(F.col("problem"))
    _settle(
        log, settled, "ingested",
        status=F.when(ok, _loaded()).otherwise("FAILED"),
        load_mode_used=F.lit(FULL_INGEST),
        target_path=F.when(ok, F.col("folder")),
        rows_parsed=F.when(ok, loaded["rows_parsed"]).otherwise(nothing["rows_parsed"]),
        rows_loaded=F.when(ok, loaded["rows_loaded"]).otherwise(nothing["rows_loaded"]),
        retry_count=F.col("retry_count") + F.lit(1 if fallback else 0),
        error_message=F.when(ok, F.col("error_message")).otherwise(failure),
    )


def import_files(
    spark: SparkSession,
    stage_uri: str,
    target: Target,
    *,
    load_mode: str = FULL_INGEST,
    stage_path: str = "",
    files: DataFrame | None = None,
    wave_size: int = _WAVE_FILES,
    log_mode: str = "reuse",
    task_id: str | None = None,
    takeover: bool = False,
    repeatable: bool = False,
) -> ImportRun:
    """Load the files below ``stage_uri`` (or a given part of its listing) that the target lacks.

    Calling it again loads only what is new or was left unfinished. A folder that was exported again replaces its
    earlier rows, see ``publish_replacements``. ``log_mode="fresh"`` forgets the log and with it the table's content;
    the files themselves stay. With ``repeatable`` a load named ``task_id`` may be asked for again: one that has finished
    is not run a second time, one that was broken off goes on.
    """
    load_mode = load_mode.upper()
    if load_mode not in LOAD_MODES:
        raise ValueError(f"load_mode is one of {', '.join(LOAD_MODES)}")
    if log_mode not in ("reuse", "fresh"):
        raise ValueError("log_mode is 'reuse' or 'fresh'")
    stage_uri = qualify(spark, stage_uri)
    runs, log = target.runs, target.files
    if repeatable and task_id is not None:
        if finished_before(runs, task_id):
            return ImportRun(task_id, target)
    else:
        refuse_reuse(runs, task_id)
    task_id = task_id or new_task_id("import", target.base_uri.rsplit("/", 1)[-1])
    run = ImportRun(task_id, target)
    refuse_concurrent(runs, takeover, own=task_id if repeatable else None)
    facts = {
        "target": target.base_uri,
        "stage_uri": stage_uri,
        "parameters": json.dumps({"load_mode": load_mode, "stage_path": stage_path, "wave_size": wave_size}),
    }
    began = datetime.now(timezone.utc)
    facts |= {"created_at": began, "started_at": began}

    def tally() -> int:
        """Count what has become of the run's files; returns how many files of any run wait to replace others."""
        mine, done = F.col("task_id") == task_id, F.col("status").isin("SUCCESS", LOADED)
        counts = log.current().agg(
            F.count_if(mine & done).alias("done"),
            F.count_if(mine & (F.col("status") == "FAILED")).alias("failed"),
            F.count_if(mine & done & (F.col("load_mode_used") != load_mode)).alias("fell_back"),
            F.count_if(F.col("status") == LOADED).alias("waiting"),
        ).first()
        run.completed, run.failed, run.fell_back = counts.done, counts.failed, counts.fell_back
        return counts.waiting

    def report(status: str) -> None:
        record_run(
            runs, task_id, "IMPORT", status, total_items=run.total, completed_items=run.completed,
            failed_items=run.failed, fallback_items=run.fell_back, replaced_items=run.replaced, **facts,
        )

    record_run(runs, task_id, "IMPORT", "RUNNING", **facts)
    try:
        if log_mode == "fresh":
            log.start_fresh()
        listing = files
        if listing is None:
            listing = materialize(list_files(spark, stage_uri), f"{log.uri}/plans/{task_id}-listing")
        exported = exported_folders(spark, stage_uri)
        if exported is not None:
            exported = materialize(exported, f"{log.uri}/plans/{task_id}-exported")
        enqueue(discover(listing, stage_uri, log, stage_path, exported), log, task_id)
        # files a crashed run left behind count as pending: nothing of theirs was published
        pending = with_status(log.current(), "PENDING", "IN_PROGRESS", "RETRYING_FULL_INGEST")
        run.total = pending.count()
        if run.total:
            ordered = with_rank(pending.drop("event", "at", "seq"), ["source_uri"], f"{log.uri}/plans/{task_id}-ranges")
            plan = materialize(ordered, f"{log.uri}/plans/{task_id}")
            ranges = wave_ranges(run.total, wave_size)
            for number, (lo, hi) in enumerate(ranges):
                if number and is_suspended(runs, task_id):
                    run.suspended = True
                    break
                wave = plan.filter((F.col("slot") >= lo) & (F.col("slot") < hi)) if len(ranges) > 1 else plan
                import_wave(wave.drop("slot"), target, log, load_mode, f"{task_id}-{number}")
                if number + 1 < len(ranges):
                    tally()
                    report("RUNNING")
        waiting = tally()
        # an export whose partition has become empty replaces rows with no file at all
        if exported is not None and (waiting or exported.filter("size(staged_files) = 0").take(1)):
            run.replaced = publish_replacements(log, stage_uri, exported, f"{log.uri}/plans/{task_id}-swapped")
    except Exception as problem:
        record_run(runs, task_id, "IMPORT", "FAILED", error_message=str(problem)[:ERROR_LIMIT], **facts)
        raise
    report("SUSPENDED" if run.suspended else "COMPLETED")
    return run


__all__ = [
    "ImportRun",
    "copy_files",
    "discover",
    "import_files",
    "ingest",
    "inspect_files",
]
