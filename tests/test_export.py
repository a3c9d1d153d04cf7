"""Profiles, plans, logs and the export job."""

import datetime as dt
import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartage.operators import export as export_module
from cartage.operators.export import (
    distribute,
    export_table,
    read_staged,
    record_run,
    select_partitions,
    staged_counts,
    suspend_run,
)
from cartage.operators.logs import (
    PARTITION_STATES,
    StateLog,
    ddl_schema,
    fold,
    latest_status,
    run_log,
)
from cartage.operators.reconcile import reconcile_export
from cartage.plans import work
from cartage.plans.profile import new_partitions, partition_profile


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def states(run):
    return {tuple(r.part_key): r for r in run.log.current().collect()}


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    """5,000 line items in 7 ship modes, as files."""
    modes = {"TRUCK": 683, "RAIL": 698, "AIR": 709, "REG AIR": 710, "SHIP": 728, "FOB": 735, "MAIL": 737}
    bounds, mode = 0, F.lit(None)
    for name, n in modes.items():
        mode = F.when((F.col("id") >= bounds) & (F.col("id") < bounds + n), name).otherwise(mode)
        bounds += n
    uri = str(tmp_path_factory.mktemp("golden"))
    money = lambda e: F.expr(e).cast("decimal(12,2)")
    day = lambda n: F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % n).cast("int"))
    spark.range(5000).select(
        F.col("id").alias("partkey"), (F.col("id") % 100).alias("suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("linenumber"), money("id % 50").alias("quantity"),
        money("id * 1.5").alias("extendedprice"), money("(id % 10) / 100").alias("discount"),
        money("(id % 8) / 100").alias("tax"), F.lit("N").alias("returnflag"), F.lit("O").alias("linestatus"),
        day(900).alias("shipdate"), day(901).alias("commitdate"), day(902).alias("receiptdate"),
        F.lit("NONE").alias("shipinstruct"), mode.alias("shipmode"), F.concat(F.lit("c"), F.col("id")).alias("comment"),
    ).write.parquet(f"{uri}/t")
    return spark.read.parquet(f"{uri}/t"), modes


def test_golden_scenario(spark, golden, folder):
    df, modes = golden
    run = export_table(df, ["shipmode"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (run.completed, run.failed, run.total) == (7, 0, 7)
    counts = {r.path_key: (r.rows, r.files) for r in staged_counts(spark, f"{folder}/stage").collect()}
    assert counts == {m.replace(" ", "_"): (n, 1) for m, n in modes.items()}
    staged = read_staged(spark, f"{folder}/stage", df.schema)
    assert rows_of(staged.drop("path_key")) == rows_of(df)
    assert all(r.matched for r in reconcile_export(run.log, staged, ["shipmode"]).collect())
    state = states(run)
    assert all(r.status == "COMPLETED" and r.rows_unloaded == r.total_rows for r in state.values())
    assert all(r.output_bytes > 0 and r.started_at and r.ended_at >= r.started_at for r in state.values())
    runs = run_log(spark, f"{folder}/log/runs").current().collect()
    assert [(r.status, r.total_items, r.completed_items, r.failed_items) for r in runs] == [("COMPLETED", 7, 7, 0)]


KEY_VALUES = {
    "string": ["a", "", None, "A B", "A#B", "A_B", "it's", "x" * 200, "__NULL__", "日本", "中国"],
    "date": [dt.date(2024, 1, 1), dt.date(1999, 12, 31), None],
    "timestamp": [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1), None],
    "timestamp_ntz": [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 12, 30), None],
    "int": [0, -1, 7, None],
    "decimal(10,2)": [Decimal("1.00"), Decimal("-1.00"), None],
    "double": [0.5, -0.0, float("nan"), None],
    "boolean": [True, False, None],
    "binary": [b"\x00", b"\xff", None],
}


@pytest.fixture(scope="module")
def round_trips(spark, tmp_path_factory):
    """One export per key type, several at a time."""
    def export(type_name):
        folder = str(tmp_path_factory.mktemp("keys"))
        rows = [(k, i) for i, k in enumerate(KEY_VALUES[type_name] * 3)]
        session = spark.newSession()
        session.createDataFrame(rows, f"k {type_name}, n int").write.parquet(f"{folder}/t")
        df = session.read.parquet(f"{folder}/t")
        run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
        return run, read_staged(session, f"{folder}/stage", df.schema)

    with ThreadPoolExecutor(5) as pool:
        yield {name: pool.submit(export, name) for name in KEY_VALUES}


@pytest.mark.parametrize("type_name", list(KEY_VALUES))
def test_round_trip_for_every_key_type(round_trips, type_name):
    run, staged = round_trips[type_name].result()
    n = len(KEY_VALUES[type_name])
    assert run.completed == n and run.failed == 0
    assert sorted(r.n for r in staged.collect()) == list(range(3 * n))
    folders = staged.groupBy("path_key").agg(F.count_distinct(F.struct("k")).alias("keys")).collect()
    assert len(folders) == n and all(r["keys"] == 1 for r in folders)
    assert all(r.rows_unloaded == 3 for r in run.log.current().collect())


def test_rerun_exports_nothing_again_and_finds_new_keys(spark, folder):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    first = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    again = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (first.total, again.total) == (2, 0)
    # the NULL key is not found anew, and a late key that sanitizes alike gets its own folder
    more = df.union(spark.createDataFrame([("a ", 3), ("a_", 4), ("b", 5)], df.schema))
    third = export_table(more, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert third.total == 3
    staged = read_staged(spark, f"{folder}/stage", df.schema)
    assert rows_of(staged.drop("path_key")) == rows_of(more)
    assert staged.select("path_key").distinct().count() == 5


def test_key_columns_may_be_named_like_log_columns(spark, folder):
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "status string, total_rows int, seq int")
    run = export_table(df, ["status", "total_rows", "seq"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert run.completed == 2
    assert {k: r.path_key for k, r in states(run).items()} == {("a", 1, 5): "a__1__5", ("b", 2, 6): "b__2__6"}


def test_fresh_log_exports_everything_again_and_keeps_history(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", log_mode="fresh")
    assert run.total == 2 and run.log.current().count() == 2
    assert len({g for g, _ in run.log.commits()}) == 2


def test_unknown_keys_columns_and_modes_are_refused(spark, folder):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    where = {"log_uri": f"{folder}/log"}
    with pytest.raises(ValueError, match="partition keys"):
        export_table(df, ["nope"], f"{folder}/s", **where)
    with pytest.raises(ValueError, match="columns not in the table"):
        export_table(df, ["k"], f"{folder}/s", columns=["N"], **where)
    with pytest.raises(ValueError, match="log_mode"):
        export_table(df, ["k"], f"{folder}/s", log_mode="drop", **where)
    with pytest.raises(ValueError, match="max_file_size"):
        export_table(df, ["k"], f"{folder}/s", max_file_size=work.MAX_FILE_SIZE + 1, **where)
    with pytest.raises(ValueError, match="reserved"):
        export_table(df.withColumn("path_key", F.lit(1)), ["k"], f"{folder}/s", **where)


def test_two_runs_on_one_stage_are_refused(spark, folder):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    runs = run_log(spark, f"{folder}/log/runs")
    record_run(runs, "OTHER", "EXPORT", "RUNNING", stage_uri=f"{folder}/stage")
    with pytest.raises(RuntimeError, match="still RUNNING"):
        export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", takeover=True, task_id="MINE")
    assert run.completed == 1
    with pytest.raises(ValueError, match="exists already"):
        export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", takeover=True, task_id="MINE")


def test_a_bad_partition_is_isolated(spark, folder):
    """One row that cannot be computed fails its own partition, in a few jobs, and no other."""
    spark.range(160).select((F.col("id") % 16).cast("string").alias("k"), F.col("id").alias("n")).write.parquet(
        f"{folder}/t"
    )
    broken = F.when(F.col("k") == "11", F.raise_error(F.lit("no such value"))).otherwise(F.col("n"))
    df = spark.read.parquet(f"{folder}/t").withColumn("n", broken.cast("bigint"))
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (run.completed, run.failed) == (15, 1)
    bad = states(run)[("11",)]
    assert bad.status == "FAILED" and "no such value" in bad.error_message and bad.retry_count == 1
    assert staged_counts(spark, f"{folder}/stage").count() == 15
    # the next run takes it up again
    good = spark.read.parquet(f"{folder}/t")
    again = export_table(good, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (again.total, again.completed) == (1, 1)
    assert read_staged(spark, f"{folder}/stage", good.schema).count() == 160


def test_a_fault_of_every_partition_fails_each(spark, folder):
    df = spark.range(64).select(F.col("id").cast("string").alias("k"), F.raise_error(F.lit("all wrong")).cast("int").alias("n"))
    df = df.filter("k < 4")
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (run.completed, run.failed) == (0, len(states(run)))


def test_crashed_run_is_taken_up(spark, folder, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")

    def crash(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(export_module, "write_partitions", crash)
    with pytest.raises(KeyboardInterrupt):
        export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    monkeypatch.undo()
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", takeover=True)
    assert run.completed == 2
    seen = [r.status for r in run.log.history().filter("part_key.k = 'a'").orderBy("seq").collect()]
    assert seen == ["PENDING", "IN_PROGRESS", "PENDING", "IN_PROGRESS", "COMPLETED"]
    assert set(seen) <= set(PARTITION_STATES)


def test_suspended_run_stops_between_waves_and_resumes(spark, folder, monkeypatch):
    spark.range(60).select((F.col("id") % 6).alias("k"), F.col("id").alias("n")).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    runs = run_log(spark, f"{folder}/log/runs")
    write = export_module.write_partitions

    def write_and_suspend(*args):
        write(*args)
        suspend_run(runs, "MINE")

    monkeypatch.setattr(export_module, "write_partitions", write_and_suspend)
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", wave_size=4, task_id="MINE")
    monkeypatch.undo()
    assert run.suspended and (run.total, run.completed, run.failed) == (6, 4, 0)
    assert Counter(r.status for r in states(run).values()) == {"COMPLETED": 4, "PENDING": 2}
    assert run_log(spark, f"{folder}/log/runs").current().first().status == "SUSPENDED"
    again = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", wave_size=4)
    assert (again.total, again.completed) == (2, 2)


def test_vanished_partition_completes_with_zero_rows(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    trial = df.filter("k = 'a'").select("k")
    export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", selection=trial)
    run = export_table(df.filter("k = 'a'"), ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (states(run)[("b",)].status, states(run)[("b",)].rows_unloaded) == ("COMPLETED", 0)


def test_waves_give_the_same_files_as_one_job(spark, folder):
    spark.range(900).select((F.col("id") % 9).alias("k"), F.col("id").alias("n")).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", wave_size=4)
    assert run.completed == 9
    assert {(r.rows, r.files) for r in staged_counts(spark, f"{folder}/stage").collect()} == {(100, 1)}
    started = run.log.history().filter("event = 'started'").groupBy("seq").count().collect()
    assert sorted(r["count"] for r in started) == [1, 4, 4]


def test_odd_stage_and_log_names(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b c", 2), (None, 3)], "k string, n int")
    stage, logs = f"{folder}/st [1] {{x}}", f"{folder}/lo*g"
    assert export_table(df, ["k"], stage, log_uri=logs, wave_size=2).completed == 3
    assert export_table(df, ["k"], stage, log_uri=logs).total == 0
    assert rows_of(read_staged(spark, stage, df.schema).drop("path_key")) == rows_of(df)


def test_many_partitions_are_ranked_in_ranges(spark, folder):
    spark.range(300).select((F.col("id") % 30).alias("k"), F.col("id").alias("n")).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", wave_size=15)
    assert (run.total, run.completed) == (30, 30)
    assert rows_of(read_staged(spark, f"{folder}/stage", df.schema).drop("path_key")) == rows_of(df)


@pytest.fixture
def skewed(spark, folder):
    """A third of the rows share one key, and all of those are copies of one row."""
    spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("n"),
    ).write.parquet(f"{folder}/t")
    return spark.read.parquet(f"{folder}/t")


def test_oversize_hot_key_is_split_evenly_even_when_all_rows_are_copies(spark, skewed, folder):
    cap = export_module.scanned_bytes(skewed) // 12
    run = export_table(skewed, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", max_file_size=cap)
    hot = states(run)[(0,)]
    assert hot.rows_unloaded == 3000 and hot.file_count >= 4
    per_file = [
        r.rows for r in spark.read.parquet(f"{folder}/stage").filter("path_key = '0'")
        .groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("rows")).collect()
    ]
    assert max(per_file) < 2 * 3000 / len(per_file)
    assert all(r.file_count == 1 for k, r in states(run).items() if k != (0,))
    assert rows_of(read_staged(spark, f"{folder}/stage", skewed.schema).drop("path_key")) == rows_of(skewed)


def test_split_works_on_a_selection_too(spark, skewed, folder):
    cap = export_module.scanned_bytes(skewed) // 12
    chosen = spark.createDataFrame([(0,), (1,)], "k int")
    run = export_table(skewed, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", max_file_size=cap, selection=chosen)
    assert run.completed == 2
    expected = rows_of(skewed.filter("k in (0, 1)"))
    assert rows_of(read_staged(spark, f"{folder}/stage", skewed.schema).drop("path_key")) == expected


def test_one_shuffle_per_export_and_no_python(spark, golden):
    df, _ = golden
    plan = spark.createDataFrame(
        [(("AIR",), "AIR", "AIR", 1)],
        "part_key struct<shipmode:string>, base_key string, path_key string, file_count bigint",
    )
    whole = distribute(df, ["shipmode"], plan, restricted=False, renamed=0, split=0)
    text = plan_text(whole)
    assert text.count("Exchange") == 1 and "Join" not in text and "Python" not in text
    one = distribute(df, ["shipmode"], plan, ["partkey", "shipmode"], renamed=0, split=0)
    text = plan_text(one)
    assert "GreaterThanOrEqual(shipmode,AIR)" in text and "LessThanOrEqual(shipmode,AIR)" in text
    assert "ReadSchema: struct<partkey:bigint,shipmode:string>" in text
    loose = distribute(df, ["shipmode"], plan, single_file=False, restricted=False, renamed=0)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(loose)


def test_profile_scans_key_columns_and_combines_before_the_shuffle(golden):
    df, _ = golden
    text = plan_text(partition_profile(df, ["shipmode"]))
    assert "ReadSchema: struct<shipmode:string>" in text and "partial_count" in text


def test_new_partitions_is_null_safe(spark):
    profile = spark.createDataFrame([("a", 1), (None, 2), ("", 3)], "k string, total_rows bigint")
    known = spark.createDataFrame([("a",), (None,)], "k string")
    assert [tuple(r) for r in new_partitions(profile, known, ["k"]).collect()] == [("", 3)]


def test_wave_ranges():
    assert work.wave_ranges(10, None) == [(0, 10)]
    assert work.wave_ranges(10, 4) == [(0, 4), (4, 8), (8, 10)]
    assert work.wave_ranges(1, 5) == [(0, 1)] and work.wave_ranges(0, 5) == []
    assert work.rows_per_file(10.0, 100) == 10 and work.rows_per_file(0.0, 1) >= 1


def test_ranks_are_counted_in_ranges(spark, folder):
    plan = spark.range(2000).select((F.col("id") % 7).alias("total_rows"), F.col("id").alias("k"))
    order = ["total_rows", "k"]
    many = work.with_rank(plan, order, f"{folder}/b")
    # only the row counts of the ranges go through a single task
    text = plan_text(many)
    assert text.count("SinglePartition") == 1 and "hashpartitioning(__range" in text
    found = sorted((r.slot, r.total_rows, r.k) for r in many.collect())
    assert [r[0] for r in found] == list(range(2000)) and [r[1:] for r in found] == sorted(r[1:] for r in found)


def test_file_counts(spark):
    df = spark.createDataFrame([(0,), (100,), (101,), (1000,)], "b bigint")
    assert [r[0] for r in df.select(work.file_count(F.col("b"), 100)).collect()] == [1, 1, 2, 10]
    assert [r[0] for r in df.select(work.file_count(F.col("b"), 100, 0.9)).collect()] == [1, 1, 2, 12]


# -------------------------------------------------------------------- logs


@pytest.fixture
def log(spark, folder):
    return StateLog(spark, f"{folder}/log", ddl_schema("item string, status string, n int"), ["item"])


def test_log_folds_to_the_latest_state(spark, log):
    assert not log.exists() and log.current().count() == 0
    rows = spark.createDataFrame([("a", "PENDING", 1), ("b", "PENDING", 2), (None, "PENDING", 3)], log.schema)
    assert log.append(rows, "first") == 1
    log.transition(rows.filter("item = 'a' or item is null"), "second", status=F.lit("SUCCESS"))
    state = {r.item: (r.status, r.seq, r.event) for r in log.current().collect()}
    assert state == {"a": ("SUCCESS", 2, "second"), "b": ("PENDING", 1, "first"), None: ("SUCCESS", 2, "second")}
    assert log.history().count() == 5


def test_unfinished_append_is_invisible_and_replaced(spark, log):
    log.append(spark.createDataFrame([("a", "PENDING", 1)], log.schema))
    # what a writer leaves behind that dies before its job is committed
    orphan = spark.createDataFrame([("x", "SUCCESS", 1)], log.schema)
    orphan.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(log._folder(0, 2))
    reopened = StateLog(spark, log.uri, log.schema, log.keys)
    assert [r.item for r in reopened.current().collect()] == ["a"]
    assert reopened.append(spark.createDataFrame([("b", "PENDING", 1)], log.schema)) == 2
    assert {r.item for r in StateLog(spark, log.uri, log.schema, log.keys).current().collect()} == {"a", "b"}


def test_generations(spark, log):
    log.append(spark.createDataFrame([("a", "PENDING", 1)], log.schema))
    log.append(spark.createDataFrame([("a", "SUCCESS", 1)], log.schema))
    log.compact()
    assert log.history().count() == 1 and log.current().first().status == "SUCCESS"
    log.start_fresh()
    assert log.current().count() == 0
    assert log.append(spark.createDataFrame([("c", "PENDING", 1)], log.schema)) > 3
    assert [r.item for r in log.current().collect()] == ["c"]


def test_fold_combines_before_the_shuffle(spark):
    history = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"), F.lit("x").alias("status"))
    assert "partial_max_by" in plan_text(fold(history, ["k"]))
    text = plan_text(latest_status(history, ["k"], ("w", "x")))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_latest_status(spark):
    rows = [("a", 1, "PENDING"), ("a", 3, "FAILED"), ("a", 2, "IN_PROGRESS"), (None, 5, "COMPLETED"), ("b", 1, None)]
    history = spark.createDataFrame(rows, "k string, seq int, status string")
    found = {tuple(r) for r in latest_status(history, ["k"], PARTITION_STATES).collect()}
    assert found == {("a", 3, "FAILED"), (None, 5, "COMPLETED"), ("b", 1, None)}


def test_selection_by_predicate_and_by_keys(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("", 3), (None, 4)], "k string, n int")
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    select_partitions(run.log, F.col("part_key.k") == "b")
    select_partitions(run.log, spark.createDataFrame([("",)], "k string"))
    assert {k[0] for k, r in states(run).items() if r.status == "PENDING"} == {"b", ""}


def _failing_keys(spark, partitions, bad):
    """One row per key; reading a bad key's value fails."""
    df = spark.range(partitions * 5).withColumn("k", (F.col("id") % partitions).cast("int"))
    return df.withColumn("v", F.when(F.col("k") < bad, F.raise_error(F.lit("no such value"))).otherwise(F.col("id")).cast("bigint"))


def test_every_failing_partition_is_settled(spark, folder):
    run = export_table(_failing_keys(spark, 10, 8).select("id", "k", "v"), ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (run.completed, run.failed) == (2, 8)
    state = {r.status: r.n for r in run.log.current().groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert state == {"COMPLETED": 2, "FAILED": 8}
    assert run.log.current().filter("status = 'FAILED' and error_message like '%no such value%'").count() == 8


def test_failing_partitions_are_told_by_reading(spark, folder, monkeypatch):
    """Forty bad partitions of 48 cost two writes, whatever their number, and about one read each."""
    checked = F.when(F.col("id") % 48 < 40, F.raise_error(F.concat(F.lit("bad "), (F.col("id") % 48).cast("string")))).otherwise(F.col("id"))
    spark.range(960).write.parquet(f"{folder}/table")
    df = spark.read.parquet(f"{folder}/table").select((F.col("id") % 48).cast("int").alias("k"), checked.cast("long").alias("v"))
    writes, inner = [], export_module.write_partitions
    monkeypatch.setattr(export_module, "write_partitions", lambda *a: writes.append(1) or inner(*a))
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
    before = jobs()
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert len(writes) == 2 and jobs() - before < 200
    assert (run.completed, run.failed) == (8, 40)
    for row in run.log.current().collect():
        k = row["part_key"]["k"]
        assert row["status"] == ("FAILED" if k < 40 else "COMPLETED")
        assert k >= 40 or f"bad {k}" in row["error_message"]


def test_one_bad_partition_among_many(spark, folder):
    """Null and timestamp keys among them; the rest is written whole."""
    value = F.when(F.col("id") == 77, F.raise_error(F.lit("no such value"))).otherwise(F.col("id"))
    key = F.when(F.col("id") % 20 > 0, F.timestamp_seconds(F.col("id") % 20 * 86400))
    df = spark.range(400).select(key.alias("k"), value.cast("long").alias("v"))
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (run.completed, run.failed) == (19, 1)
    assert run.log.current().filter("status = 'COMPLETED'").agg(F.sum("rows_unloaded")).first()[0] == 380


def test_failing_machines_end_the_run_with_finished_work_settled(spark, folder, monkeypatch):
    df = spark.range(100).withColumn("k", (F.col("id") % 10).cast("int"))
    whole = export_module.write_partitions
    calls = []

    def write(rows, *rest):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("a value is bad")  # the wave is halved
        if len(calls) == 3:
            raise RuntimeError("ExecutorLostFailure: all of them")
        return whole(rows, *rest)

    monkeypatch.setattr(export_module, "write_partitions", write)
    with pytest.raises(RuntimeError, match="ExecutorLost"):
        export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    log = export_module.open_partition_log(spark, f"{folder}/log", df, ["k"])
    state = {r.status: r.n for r in log.current().groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert state == {"COMPLETED": 5, "IN_PROGRESS": 5}


def test_vanished_partition_leaves_no_stale_file(spark, folder):
    full = spark.range(60).withColumn("k", (F.col("id") % 3).cast("int"))
    export_table(full, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    again = export_table(full.filter("k <> 1"), ["k"], f"{folder}/stage", log_uri=f"{folder}/log", selection=F.lit(True))
    assert (again.completed, again.failed) == (3, 0)
    assert spark.read.parquet(f"{folder}/stage").filter("path_key = 1").count() == 0


def test_crashed_run_replaces_its_own_files_without_overwrite(spark, folder):
    df = spark.range(40).withColumn("k", (F.col("id") % 4).cast("int"))
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    run.log.transition(
        run.log.current().filter("part_key.k < 2"), "started",
        status=F.lit("IN_PROGRESS"), started_at=F.current_timestamp(), ended_at=F.lit(None),
    )
    again = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", overwrite=False)
    assert (again.completed, again.failed) == (2, 0)
    assert spark.read.parquet(f"{folder}/stage").count() == 40


def test_the_cap_holds_for_one_key_of_wide_rows(spark, folder):
    df = spark.range(4000).withColumn("k", F.when(F.col("id") < 400, "wide").otherwise("thin"))
    df = df.withColumn("v", F.when(
        F.col("k") == "wide", F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(i)), 512) for i in range(20)])
    ).otherwise("x"))
    df.write.parquet(f"{folder}/table")
    table = spark.read.parquet(f"{folder}/table")
    cap = 200_000
    export_table(table, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", max_file_size=cap)
    counts = {r.path_key: (r.files, r.rows) for r in staged_counts(spark, f"{folder}/stage").collect()}
    assert counts["thin"] == (1, 3600) and counts["wide"][0] > 1 and counts["wide"][1] == 400
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/stage").agg(F.max("length"))
    assert sizes.first()[0] <= cap


def wide(column, words):
    return F.concat(*[F.sha2(F.concat(column.cast("string"), F.lit(str(i))), 512) for i in range(words)])


@pytest.mark.parametrize("single", [True, False])
@pytest.mark.parametrize("rows", ["narrow", "wide", "mixed", "clustered"])
def test_no_file_is_beyond_the_cap(spark, folder, rows, single):
    """Rows of one width, of very different widths, and widths that depend on where a row lies."""
    words = {
        "narrow": F.lit(""),
        "wide": wide(F.col("id"), 12),
        "mixed": F.when(F.col("id") % 37 == 0, wide(F.col("id"), 40)).otherwise(wide(F.col("id"), 1)),
        "clustered": F.when(F.col("id") < 300, wide(F.col("id"), 24)).otherwise(F.lit("x")),
    }[rows]
    count, cap = (60_000, 60_000) if rows == "narrow" else (2500, 150_000)
    spark.range(0, count, 1, 5).select("id", (F.col("id") % 2).alias("k"), words.alias("v")).write.parquet(f"{folder}/table")
    table = spark.read.parquet(f"{folder}/table")
    run = export_table(table, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", max_file_size=cap, single_file=single)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/stage").select("path", "length").collect()
    assert run.completed == 2 and run.failed == 0 and max(f["length"] for f in files) <= cap
    assert len(files) < 4 * sum(f["length"] for f in files) / cap + 2
    staged = read_staged(spark, f"{folder}/stage", table.schema).drop("path_key")
    assert staged.exceptAll(table).isEmpty() and staged.count() == count


def test_a_row_beyond_the_cap_fails_its_partition_with_the_reason(spark, folder):
    df = spark.range(40).select("id", (F.col("id") % 4).alias("k"), F.when(F.col("id") == 5, wide(F.col("id"), 400)).otherwise("x").alias("v"))
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", max_file_size=20_000)
    state = {r["part_key"]["k"]: r for r in run.log.current().collect()}
    assert (run.completed, run.failed) == (3, 1)
    assert state[1]["status"] == "FAILED" and "beyond the cap of 20000" in state[1]["error_message"]


def test_a_wide_key_is_weighed_before_the_first_write(spark, folder, monkeypatch):
    """Its rows lie in files of their own, whose sizes tell; so it is written once."""
    values = F.when(F.col("id") < 400, wide(F.col("id"), 20)).otherwise("x")
    rows = spark.range(0, 4000, 1, 10).select("id", (F.col("id") < 400).alias("k"), values.alias("v"))
    rows.write.parquet(f"{folder}/table")
    written = []
    inner = export_module.write_partitions
    monkeypatch.setattr(export_module, "write_partitions", lambda *a: written.append(1) or inner(*a))
    table = spark.read.parquet(f"{folder}/table")
    run = export_table(table, ["k"], f"{folder}/stage", log_uri=f"{folder}/log", max_file_size=200_000)
    state = {r["part_key"]["k"]: r for r in run.log.current().collect()}
    assert len(written) == 1 and state[True]["file_count"] > 1 and state[False]["file_count"] == 1


def test_large_partitions_do_not_share_a_task(spark, folder, monkeypatch):
    """Partitions of like size, more than there are shuffle partitions: each is written by a task of its own."""
    spark.range(0, 60_000, 1, 4).select((F.col("id") % 7).cast("int").alias("k"), wide(F.col("id"), 1).alias("v")).write.parquet(f"{folder}/t")
    placed, inner = [], export_module.write_partitions

    def seen(rows, *rest):
        tasks = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("path_key").alias("keys"))
        placed.extend(r["keys"] for r in tasks.collect())
        inner(rows, *rest)

    monkeypatch.setattr(export_module, "write_partitions", seen)
    monkeypatch.setattr(export_module, "_OWN_BYTES", 1000)
    run = export_table(spark.read.parquet(f"{folder}/t"), ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert placed == [1] * 7 and run.completed == 7
    assert {r["file_count"] for r in run.log.current().collect()} == {1}


def test_snapshots_shorten_what_is_read(spark, folder, monkeypatch):
    """The state comes from the last snapshot and the appends since; one that ends late is not lost, the history stays."""
    from cartage.operators import logs

    monkeypatch.setattr(logs, "SNAPSHOT_EVERY", 5)
    df = spark.range(3).withColumn("k", F.col("id").cast("int"))
    log = export_module.open_partition_log(spark, f"{folder}/log", df, ["k"])

    def row(k, status):
        given = spark.range(1).select(F.struct(F.lit(k).alias("k")).alias("part_key"), F.lit(status).alias("status"))
        return given.select("*", *[F.lit(None).alias(f.name) for f in log.schema if f.name not in given.columns])

    def state(of):
        return {r["part_key"]["k"]: r["status"] for r in of.current().collect()}

    log.append(row(0, "PENDING"))
    log.append(row(1, "PENDING"))
    late = export_module.open_partition_log(spark, f"{folder}/log", df, ["k"])
    claimed = f"{folder}/log/partitions/claims/3"
    os.makedirs(os.path.dirname(claimed), exist_ok=True)
    open(claimed, "w").close()  # a writer takes number 3 and is slow
    for step in range(4):
        log.append(row(0, f"step {step}"))
    assert state(log) == {0: "step 3", 1: "PENDING"} and log.history().count() == 6
    other = export_module.open_partition_log(spark, f"{folder}/log", df, ["k"])
    folder_, last, without = other._snapshot()
    assert without == {3} and len(other._uncovered((folder_, last, without))) == 1
    shaped = row(2, "FAILED").select(*[F.col(f.name).cast(f.dataType) for f in log.schema], F.lit("late").alias("event"), F.current_timestamp().alias("at"))
    shaped.write.mode("overwrite").parquet(late._folder(late._generation(), 3))
    other.refresh()
    assert state(other) == {0: "step 3", 1: "PENDING", 2: "FAILED"}
    other.start_fresh()
    assert state(other) == {} and len(other._latest()) == 1 and len({g for g, _ in other.commits()}) == 2


def test_writers_that_meet_keep_each_others_rows(spark, folder):
    df = spark.range(2).withColumn("k", F.col("id").cast("int"))
    one, other = (export_module.open_partition_log(spark, f"{folder}/log", df, ["k"]) for _ in range(2))
    for log in (one, other):
        log.commits()
    for number, log in enumerate((one, other)):
        row = spark.range(1).select(F.struct(F.lit(number).alias("k")).alias("part_key"), F.lit("PENDING").alias("status"))
        log.append(row.select("*", *[F.lit(None).alias(f.name) for f in log.schema if f.name not in row.columns]))
    one.refresh()
    assert one.current().count() == 2


def test_a_name_the_store_refuses_fails_its_own_partition(spark, folder):
    df = spark.createDataFrame([("a", 1), ("x" * 300, 2), ("b", 3)], "k string, n int")
    run = export_table(df, ["k"], f"{folder}/stage", log_uri=f"{folder}/log")
    assert (run.completed, run.failed) == (2, 1)
