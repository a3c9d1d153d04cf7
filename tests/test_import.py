"""Listings, footers, load modes, fallback, the target's manifest, clean-up and streaming."""

import datetime as dt
import glob
import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartage.functions.types import bind_by_name
from cartage.operators import load as load_module
from cartage.operators import reports
from cartage.operators.cleanup import cleanup_plan, remove_files, selected_files
from cartage.operators.export import export_table, exported_folders
from cartage.operators.load import copy_types, import_files, location_problem
from cartage.operators.logs import FILE_STATES, failed_as_pending, fold
from cartage.operators.reconcile import compare_counts, reconcile_files
from cartage.operators.target import (
    ADD_FILES_COPY,
    ADD_FILES_REFERENCE,
    FULL_INGEST,
    Target,
    read_target,
)
from cartage.session import scratch, session_setting, work_root
from cartage.sources.files import files_only, list_files, read_footers, with_md5
from cartage.streaming.incremental import import_stream

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("at", T.TimestampNTZType()),
])


def good(spark, start=0, n=10):
    return spark.range(start, start + n, 1, 1).select(
        "id",
        F.concat(F.lit("n"), F.col("id")).alias("name"),
        (F.col("id") / 2).alias("price"),
        F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("at"),
    )


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def file_states(target):
    return {r.file_path.split("/")[0]: r for r in target.files.current().collect()}


@pytest.fixture
def stage(spark, folder):
    """One folder per kind of file."""
    root = f"{folder}/stage"
    base = good(spark)
    variants = {
        "fit": base,
        "int_key": good(spark, 100).withColumn("id", F.col("id").cast("int")),
        "float_price": good(spark, 200).withColumn("price", F.col("price").cast("float")),
        "missing": good(spark, 300).drop("price"),
        "extra": good(spark, 400).withColumn("more", F.lit(1)),
        "case": good(spark, 500).withColumnRenamed("name", "NAME"),
        "text_id": good(spark, 600).withColumn("id", F.col("id").cast("string")),
        "bad_text": good(spark, 700).withColumn("id", F.concat(F.lit("x"), F.col("id"))),
        "no_cast": good(spark, 800).withColumn("price", F.array("price")),
        "empty": base.limit(0),
    }
    for name, df in variants.items():
        df.coalesce(1).write.parquet(f"{root}/{name}")
    with session_setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MILLIS"):
        good(spark, 900).withColumn("at", F.col("at").cast("timestamp")).write.parquet(f"{root}/millis")
    with session_setting(spark, "spark.sql.parquet.outputTimestampType", "INT96"):
        good(spark, 1000).withColumn("at", F.col("at").cast("timestamp")).write.parquet(f"{root}/int96")
    os.makedirs(f"{root}/broken")
    with open(f"{root}/broken/f.parquet", "wb") as f:
        f.write(b"PAR1 this is no parquet file")
    open(f"{root}/broken/zero.parquet", "wb").close()
    # a file whose footer is sound but whose data is not
    good(spark, 1100, 5000).coalesce(1).write.option("compression", "gzip").parquet(f"{root}/rotten")
    path = glob.glob(f"{root}/rotten/*.parquet")[0]
    with open(path, "r+b") as f:
        f.seek(40)
        f.write(b"\xff" * 400)
    for crc in glob.glob(f"{root}/rotten/.*.crc"):
        os.truncate(crc, 0)
        with open(crc, "wb") as f:
            f.write(b"crc\x00\x00\x00\x02\x00")
    return root


@pytest.fixture
def plain_stage(spark, folder):
    good(spark, 0, 60).repartition(3, "id").write.parquet(f"{folder}/stage/a")
    return f"{folder}/stage"


def test_listing_and_checksums(spark, stage):
    listing = list_files(spark, stage)
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
    files = {r.path: r.length for r in files_only(listing).collect()}
    assert all(n > 0 for n in files.values()) and not any("zero" in f or "_SUCCESS" in f for f in files)
    fit = with_md5(listing.filter(F.contains("path", F.lit("/fit/")))).first()
    with open(fit.path.removeprefix("file:"), "rb") as f:
        assert fit.md5 == hashlib.md5(f.read()).hexdigest()
    assert list_files(spark, stage + "/nowhere").count() == 0


def test_footers_tell_types_units_and_damage(spark, stage):
    found = {r.path.split("/stage/")[1].split("/")[0]: r for r in read_footers(files_only(list_files(spark, stage))).collect()}
    columns = {c.name: (c.type, c.unit) for c in found["fit"].columns}
    assert columns == {
        "id": ("bigint", None), "name": ("string", None), "price": ("double", None), "at": ("timestamp_ntz", "MICROS"),
    }
    assert found["fit"].num_rows == 10 and found["empty"].num_rows == 0
    assert {c.name: c.unit for c in found["millis"].columns}["at"] == "MILLIS"
    assert {c.name: (c.type, c.unit) for c in found["int96"].columns}["at"] == ("timestamp", "INT96")
    assert found["broken"].error and found["broken"].num_rows is None


def test_full_ingest_takes_what_casts_and_isolates_the_rest(spark, stage, folder):
    target = Target(spark, f"{folder}/target", SCHEMA)
    run = import_files(spark, stage, target, load_mode=FULL_INGEST)
    state = file_states(target)
    failed = {name for name, r in state.items() if r.status == "FAILED"}
    assert failed == {"bad_text", "no_cast", "broken", "rotten"}
    assert (run.failed, run.completed, run.total) == (4, 10, 14)
    assert all(state[f].error_message and state[f].rows_loaded is None for f in failed)
    assert "CAST" in state["bad_text"].error_message and "price" in state["no_cast"].error_message
    ok = [r for r in state.values() if r.status == "SUCCESS"]
    assert all(r.load_mode_used == FULL_INGEST and r.rows_loaded == r.rows_parsed for r in ok)
    table = read_target(target)
    assert table.schema.simpleString() == SCHEMA.simpleString()
    assert table.count() == sum(r.rows_loaded for r in ok) == 90
    # bound by exact name: missing and case-differing columns are NULL, extra ones dropped
    assert table.filter("id between 300 and 309 and price is null").count() == 10
    assert table.filter("id between 500 and 509 and name is null").count() == 10
    assert rows_of(table.filter("id between 900 and 909")) == rows_of(good(spark, 900))
    assert rows_of(table.filter("id between 1000 and 1009")) == rows_of(good(spark, 1000))
    assert rows_of(table.filter("id between 600 and 609")) == rows_of(good(spark, 600))
    assert reconcile_files(target).first().matched
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_copy_falls_back_to_ingest_and_keeps_the_reason(spark, stage, folder):
    target = Target(spark, f"{folder}/target", SCHEMA)
    run = import_files(spark, stage, target, load_mode=ADD_FILES_COPY)
    state = file_states(target)
    copied = {n for n, r in state.items() if r.load_mode_used == ADD_FILES_COPY}
    # rotten data is copied like any other bytes: a copy looks at the footer only
    assert copied == {"fit", "int_key", "float_price", "missing", "extra", "empty", "rotten"}
    assert all(state[n].error_message is None for n in copied)
    fell_back = {n for n, r in state.items() if r.status == "SUCCESS" and r.load_mode_used == FULL_INGEST}
    assert fell_back == {"case", "text_id", "millis", "int96"} and run.fell_back == 4
    assert all(state[n].error_message.startswith("ADD_FILES_COPY failed: ") for n in fell_back)
    assert "MILLIS" in state["millis"].error_message and "case" in state["case"].error_message
    failed = {n for n, r in state.items() if r.status == "FAILED"}
    assert failed == {"bad_text", "no_cast", "broken"}
    assert all(state[n].error_message.endswith(" (after ADD_FILES_COPY fallback)") for n in failed)
    current = target.files.current()
    assert reports.fallback_audit(current).count() == 4 and reports.failed_after_fallback(current).count() == 3
    seen = [
        r.status for r in target.files.history().filter("file_path like 'millis/%'").orderBy("seq").collect()
    ]
    assert seen == ["PENDING", "IN_PROGRESS", "RETRYING_FULL_INGEST", "SUCCESS"] and set(seen) <= set(FILE_STATES)
    table = read_target(target)
    assert rows_of(table.filter("id between 100 and 109")) == rows_of(good(spark, 100))
    assert rows_of(table.filter("id between 200 and 209")) == rows_of(good(spark, 200))


def test_reference_registers_exact_files_in_place(spark, stage, folder):
    target = Target(spark, folder, SCHEMA)
    before = set(glob.glob(f"{stage}/*/*"))
    # registering looks at footers only, so it would take the rotten file as well
    sound = list_files(spark, stage).filter(~F.contains("path", F.lit("/rotten/")))
    run = import_files(spark, stage, target, load_mode=ADD_FILES_REFERENCE, files=sound)
    state = file_states(target)
    assert {n for n, r in state.items() if r.status == "SUCCESS"} == {"fit", "missing", "extra", "empty"}
    assert run.failed == 9 and set(glob.glob(f"{stage}/*/*")) == before
    assert not os.path.exists(f"{folder}/data")
    assert all(r.target_path == r.source_uri for r in state.values() if r.status == "SUCCESS")
    assert read_target(target).count() == 30


def test_reference_refuses_places_outside_or_reserved(spark):
    cases = {
        "s3://b/table/part_a/f": None,
        "s3://b/table/data/f": "data/ under the base location is reserved",
        "s3://b/table/metadata/x/f": "metadata/ under the base location is reserved",
        "s3://b/table_two/part_a/f": "file is not under the table's base location s3://b/table/",
        "s3://b/table/database/f": None,
    }
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    found = {r.p: r.problem for r in df.select("p", location_problem(F.col("p"), "s3://b/table").alias("problem")).collect()}
    assert found == cases


def test_reference_reads_only_registered_files(spark, folder):
    """Files that turn up later in a registered folder, or below it, are no part of the table."""
    stage = f"{folder}/incoming"
    good(spark, 0, 10).coalesce(1).write.parquet(f"{stage}/a")
    good(spark, 10, 10).coalesce(1).write.parquet(f"{stage}/b/c")
    target = Target(spark, folder, SCHEMA)
    import_files(spark, stage, target, load_mode=ADD_FILES_REFERENCE)
    assert read_target(target).count() == 20
    good(spark, 20, 10).coalesce(1).write.mode("append").parquet(f"{stage}/a")
    good(spark, 30, 10).coalesce(1).write.parquet(f"{stage}/b/c/d")
    assert rows_of(read_target(target)) == rows_of(good(spark, 0, 20))
    import_files(spark, stage, target, load_mode=ADD_FILES_REFERENCE)
    assert rows_of(read_target(target)) == rows_of(good(spark, 0, 40))


def test_copy_types():
    assert copy_types(T.DecimalType(38, 0))[-4:] == ["tinyint", "smallint", "int", "bigint"]
    assert "bigint" not in copy_types(T.DecimalType(12, 0)) and "int" in copy_types(T.DecimalType(12, 0))
    assert "decimal(5,2)" in copy_types(T.DecimalType(12, 2)) and "decimal(5,3)" not in copy_types(T.DecimalType(12, 2))
    assert copy_types(T.DoubleType()) == ["double", "float"]
    assert copy_types(T.StringType()) == ["string"]


def test_copied_integers_read_as_wide_decimals(spark, plain_stage, folder):
    schema = T.StructType.fromDDL("id decimal(38,0), name string")
    target = Target(spark, f"{folder}/target", schema)
    run = import_files(spark, plain_stage, target, load_mode=ADD_FILES_COPY)
    assert run.fell_back == 0 and run.completed == 3
    assert read_target(target).agg(F.sum("id")).first()[0] == sum(range(60))


@pytest.mark.parametrize("mode", [FULL_INGEST, ADD_FILES_COPY])
def test_rerun_adds_nothing_and_new_files_are_found(spark, plain_stage, folder, mode):
    target = Target(spark, f"{folder}/target", SCHEMA)
    assert import_files(spark, plain_stage, target, load_mode=mode, wave_size=2).completed == 3
    assert import_files(spark, plain_stage, target, load_mode=mode).total == 0
    good(spark, 60, 5).coalesce(1).write.parquet(f"{plain_stage}/b")
    assert import_files(spark, plain_stage, target, load_mode=mode).completed == 1
    assert rows_of(read_target(target)) == rows_of(good(spark, 0, 65))
    assert target.files.current().agg(F.sum("rows_loaded")).first()[0] == 65


@pytest.mark.parametrize("crash_in", ["ingest", "_settle"])
def test_crashed_import_is_invisible_and_taken_up(spark, plain_stage, folder, monkeypatch, crash_in):
    """The data of a load may be in place already; without its log rows nobody sees it."""
    target = Target(spark, f"{folder}/target", SCHEMA)

    def crash(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(load_module, crash_in, crash)
    with pytest.raises(KeyboardInterrupt):
        import_files(spark, plain_stage, target, load_mode=FULL_INGEST)
    monkeypatch.undo()
    assert read_target(target).count() == 0
    with pytest.raises(RuntimeError, match="still RUNNING"):
        import_files(spark, plain_stage, target, load_mode=FULL_INGEST)
    assert import_files(spark, plain_stage, target, load_mode=FULL_INGEST, takeover=True).completed == 3
    assert rows_of(read_target(target)) == rows_of(good(spark, 0, 60))


def test_fresh_log_empties_the_table_and_loads_again(spark, plain_stage, folder):
    target = Target(spark, f"{folder}/target", SCHEMA)
    import_files(spark, plain_stage, target)
    run = import_files(spark, plain_stage, target, log_mode="fresh")
    assert run.completed == 3 and rows_of(read_target(target)) == rows_of(good(spark, 0, 60))


def test_two_stages_with_the_same_relative_paths(spark, folder):
    target = Target(spark, f"{folder}/target", SCHEMA)
    for number in (1, 2):
        good(spark, number * 10).coalesce(1).write.parquet(f"{folder}/stage{number}/a")
        os.rename(glob.glob(f"{folder}/stage{number}/a/*.parquet")[0], f"{folder}/stage{number}/a/data.parquet")
        for crc in glob.glob(f"{folder}/stage{number}/a/.*.crc"):
            os.truncate(crc, 0)
        import_files(spark, f"{folder}/stage{number}", target, load_mode=ADD_FILES_COPY)
    assert rows_of(read_target(target)) == rows_of(good(spark, 10, 20))


def test_odd_path_names(spark, folder):
    good(spark).coalesce(1).write.parquet(f"{folder}/st age/k=[a]{{b}} c%20d")
    target = Target(spark, f"{folder}/tar get [x]", SCHEMA)
    for mode in (FULL_INGEST, ADD_FILES_COPY):
        run = import_files(spark, f"{folder}/st age", target, load_mode=mode, log_mode="fresh")
        assert (run.completed, run.failed) == (1, 0)
        assert rows_of(read_target(target)) == rows_of(good(spark))


def test_unknown_modes_are_refused(spark, folder):
    target = Target(spark, f"{folder}/target", SCHEMA)
    with pytest.raises(ValueError, match="load_mode"):
        import_files(spark, folder, target, load_mode="MERGE")
    with pytest.raises(ValueError, match="log_mode"):
        import_files(spark, folder, target, log_mode="drop")


def test_stream_loads_each_file_once(spark, plain_stage, folder):
    target = Target(spark, f"{folder}/target", SCHEMA)
    run = lambda: import_stream(
        spark, plain_stage, target, f"{folder}/checkpoint", load_mode=ADD_FILES_COPY, max_files_per_batch=2
    ).awaitTermination()
    run()
    run()
    assert rows_of(read_target(target)) == rows_of(good(spark, 0, 60))
    good(spark, 60, 5).coalesce(1).write.parquet(f"{plain_stage}/b")
    run()
    assert rows_of(read_target(target)) == rows_of(good(spark, 0, 65))
    assert target.runs.current().filter("total_items > 0").count() == 3


def numbers(spark, first, after):
    return spark.range(first, after).select("id", F.lit("k").alias("key"))


def contents(target):
    return sorted(r["id"] for r in read_target(target).collect())


def test_new_files_after_a_cleanup_are_loaded(spark, folder):
    """Loaded files are gone from a folder, others have appeared: they are new rows, in a flat stage too."""
    target = Target(spark, f"{folder}/target", numbers(spark, 0, 1).schema)
    numbers(spark, 0, 100).coalesce(1).write.parquet(f"{folder}/stage")
    assert import_files(spark, f"{folder}/stage", target).completed == 1
    numbers(spark, 100, 250).coalesce(1).write.mode("overwrite").parquet(f"{folder}/stage")
    run = import_files(spark, f"{folder}/stage", target)
    assert (run.total, run.completed, run.failed, run.replaced) == (1, 1, 0, 0)
    assert contents(target) == list(range(250))


@pytest.mark.parametrize("mode", [FULL_INGEST, ADD_FILES_COPY])
def test_reexported_partition_replaces_its_rows(spark, folder, mode):
    def export(first, after):
        export_table(numbers(spark, first, after), ["key"], f"{folder}/stage", log_uri=f"{folder}/log", selection=F.lit(True))

    target = Target(spark, f"{folder}/target", numbers(spark, 0, 1).schema)
    for first, after in ((0, 50), (0, 50), (20, 90), (0, 0)):
        export(first, after)
        run = import_files(spark, f"{folder}/stage", target, load_mode=mode)
        assert run.failed == 0 and contents(target) == list(range(first, after))
    assert import_files(spark, f"{folder}/stage", target, load_mode=mode).replaced == 0


def test_replacement_waits_until_all_files_are_loaded(spark, folder, monkeypatch):
    """While a file of the new generation cannot be loaded the table keeps the old rows; then both change at once."""
    from cartage.operators import load

    target = Target(spark, f"{folder}/target", numbers(spark, 0, 1).schema)
    stage, log = f"{folder}/stage", f"{folder}/log"
    export_table(numbers(spark, 0, 3000), ["key"], stage, log_uri=log)
    import_files(spark, stage, target)
    export_table(numbers(spark, 1000, 6000).repartition(4), ["key"], stage, log_uri=log, selection=F.lit(True), max_file_size=12_000)
    state = exported_folders(spark, stage).first()
    assert len(state["staged_files"]) > 1
    inner, calls = load.ingest, []

    def some_fail(files, target, load_id):
        calls.append(load_id)
        return inner(files[1:], target, load_id) + [(files[0].source_uri, None, "store is down")]

    monkeypatch.setattr(load, "ingest", some_fail)
    run = import_files(spark, stage, target)
    assert run.failed == 1 and run.completed == len(state["staged_files"]) - 1 and run.replaced == 0
    assert contents(target) == list(range(3000))
    monkeypatch.undo()
    log_ = target.files
    log_.transition(failed_as_pending(log_.current()))
    run = import_files(spark, stage, target)
    assert run.completed == 1 and run.replaced == 1
    assert contents(target) == list(range(1000, 6000))


def test_files_of_a_broken_export_are_not_loaded(spark, folder, monkeypatch):
    """A run that dies between writing and settling publishes nothing to importers."""
    from cartage.operators import export

    target = Target(spark, f"{folder}/target", numbers(spark, 0, 1).schema)
    stage, log = f"{folder}/stage", f"{folder}/log"

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(export, "per_folder", dies)
    with pytest.raises(KeyboardInterrupt):
        export_table(numbers(spark, 0, 50), ["key"], stage, log_uri=log)
    monkeypatch.undo()
    assert list_files(spark, stage).count() == 1
    assert import_files(spark, stage, target).total == 0 and contents(target) == []
    export_table(numbers(spark, 0, 50), ["key"], stage, log_uri=log, takeover=True)
    assert import_files(spark, stage, target).completed == 1 and contents(target) == list(range(50))


def test_a_stream_batch_run_twice_loads_once(spark, folder, monkeypatch):
    from cartage.operators import load
    from cartage.streaming.incremental import batch_name

    target = Target(spark, f"{folder}/target", numbers(spark, 0, 1).schema)
    numbers(spark, 0, 40).repartition(3).write.parquet(f"{folder}/stage")
    batch = list_files(spark, f"{folder}/stage")
    name = batch_name(spark, f"{folder}/checkpoint", 0)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(load, "import_wave", dies)
    with pytest.raises(KeyboardInterrupt):
        import_files(spark, f"{folder}/stage", target, files=batch, task_id=name, repeatable=True)
    monkeypatch.undo()
    assert import_files(spark, f"{folder}/stage", target, files=batch, task_id=name, repeatable=True).completed == 3
    assert import_files(spark, f"{folder}/stage", target, files=batch, task_id=name, repeatable=True).total == 0
    assert contents(target) == list(range(40))


def test_cleanup_is_a_plan_until_confirmed(spark, plain_stage, folder):
    target = Target(spark, f"{folder}/target", SCHEMA)
    import_files(spark, plain_stage, target)
    good(spark, 60, 5).coalesce(1).write.parquet(f"{plain_stage}/b")
    orphans = cleanup_plan(list_files(spark, plain_stage), target.files.current())
    assert orphans.count() == 1
    with pytest.raises(ValueError, match="confirm"):
        remove_files(orphans)
    assert [r.problem for r in remove_files(orphans, confirm=True).collect()] == [None]
    left = list_files(spark, plain_stage)
    assert left.count() == 3 and cleanup_plan(left, target.files.current()).count() == 0
    chosen = selected_files(left, F.contains("path", F.lit("part-00000")))
    remove_files(chosen, confirm=True).collect()
    assert list_files(spark, plain_stage).count() == 2


# ----------------------------------------------------------------- reports


def test_comparison_counts_what_one_side_lacks(spark):
    planned = spark.createDataFrame([("a", 1), (None, 2), ("gone", 3)], "k string, planned_rows bigint")
    actual = spark.createDataFrame([("a", 1), (None, 5), ("new", 4)], "k string, actual_rows bigint")
    found = {tuple(r) for r in compare_counts(planned, actual, ["k"]).collect()}
    assert found == {("a", 1, 1, True), (None, 2, 5, False), ("gone", 3, 0, False), ("new", 0, 4, False)}


def test_counts_are_zero_filled_and_retries_count_as_in_progress(spark):
    state = spark.createDataFrame([("SUCCESS",), ("RETRYING_FULL_INGEST",), ("IN_PROGRESS",)], "status string")
    counts = {r.status: r.item_count for r in reports.import_status_counts(state).collect()}
    assert counts == {"PENDING": 0, "IN_PROGRESS": 2, "SUCCESS": 1, "FAILED": 0}
    partitions = spark.createDataFrame([("t", "NOT_SELECTED"), ("t", "COMPLETED"), ("t", "PENDING")], "task_id string, status string")
    assert sum(r.item_count for r in reports.status_counts(partitions).collect()) == 2
    assert [tuple(r) for r in reports.progress(partitions, ["task_id"]).collect()] == [("t", 2, 1, 0.5)]


def test_run_progress_covers_all_runs(spark):
    runs = spark.createDataFrame([("t", "EXPORT", "RUNNING"), ("u", "EXPORT", "CREATED")], "task_id string, operation string, status string")
    state = spark.createDataFrame([("t", "COMPLETED"), ("t", "FAILED")], "task_id string, status string")
    found = {r.task_id: (r.selected_items, r.completed_items, r.progress) for r in reports.run_progress(runs, state).collect()}
    assert found == {"t": (2, 1, 0.5), "u": (None, None, None)}


def test_log_view_shows_blanks_for_nulls(spark):
    state = spark.createDataFrame([("b", None, None, dt.date(2024, 1, 1)), ("a", "x" * 40, 3, None)], "k string, e string, n int, d date")
    rows = [tuple(r) for r in reports.log_view(state, [F.col("k")], 1).collect()]
    assert rows == [("a", "x" * 27 + "...", 3, None)]


def test_fold_with_a_hot_item(spark):
    """A third of a history may belong to one item; it is combined before the shuffle."""
    history = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("item"),
        F.col("id").alias("seq"), F.lit("S").alias("status"),
    )
    state = {r.item: r.seq for r in fold(history, ["item"]).collect()}
    assert len(state) == 500 and state[0] == 29997 or state[0] == 29999


def test_scratch_follows_the_checkpoint_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or work_root(spark) == named.rstrip("/")
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second and "/cartage/x-" in first


def test_structs_inside_maps_bind_by_name(spark, folder):
    source = spark.sql("select map('x', named_struct('a', 1, 'b', 2, 'c', 3)) as m, array(map(1, named_struct('a', 4, 'b', 5))) as n")
    wanted = T.StructType.fromDDL("m map<string, struct<b: int, a: int, d: string>>, n array<map<int, struct<b: int, a: int>>>")
    row = bind_by_name(source, wanted).first()
    assert row.m["x"].asDict() == {"b": 2, "a": 1, "d": None}
    assert row.n[0][1].asDict() == {"b": 5, "a": 4}
