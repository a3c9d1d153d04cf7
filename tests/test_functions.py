"""Types, keys, paths and texts on the edge cases the tables do not hold."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartage.functions import keys, paths, texts, types
from cartage.session import session_setting
from cartage.sources.tables import catalog_tables, column_list, describe_columns, select_columns


def values(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize(
    "type_name, wanted, others",
    [
        ("string", "REG AIR", ["AIR", "", None, "it's"]),
        ("string", "it's", ["its", "", None]),
        ("string", "", [None, " ", "x"]),
        ("string", None, ["", "NULL", "None"]),
        ("date", dt.date(2024, 1, 31), [dt.date(2024, 2, 1), None]),
        ("timestamp_ntz", dt.datetime(2024, 1, 31, 10, 0, 0, 5), [dt.datetime(2024, 1, 31, 10), None]),
        ("int", -7, [7, 0, None]),
        ("decimal(12,2)", Decimal("10.50"), [Decimal("10.05"), None]),
        ("boolean", False, [True, None]),
        ("double", 1.5, [2.5, None]),
    ],
)
def test_predicate_selects_one_key_and_only_it(spark, type_name, wanted, others):
    df = spark.createDataFrame([(v,) for v in [wanted, *others, wanted]], f"k {type_name}")
    found = values(df.filter(keys.partition_predicate({"k": wanted}, df.schema)))
    assert found == [wanted, wanted]


def test_predicate_reaches_the_scan(spark, folder):
    spark.range(100).withColumn("k", F.col("id") % 5).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    selected = spark.createDataFrame([(1,), (3,)], "k bigint")
    plan = keys.restrict_to_keys(df, selected, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,1)" in plan and "LessThanOrEqual(k,3)" in plan
    assert keys.restrict_to_keys(df, selected, ["k"]).count() == 40
    assert keys.restrict_to_keys(df, selected.limit(0), ["k"]).count() == 0


def test_restrict_keeps_null_and_empty_apart(spark):
    df = spark.createDataFrame([("a", 1), ("", 1), (None, 1), (None, 2)], "k string, n int")
    only_null = keys.restrict_to_keys(df, df.filter("k is null").select("k").distinct(), ["k"])
    assert sorted(tuple(r) for r in only_null.collect()) == [(None, 1), (None, 2)]
    only_empty = keys.restrict_to_keys(df, df.filter("k = ''").select("k"), ["k"])
    assert [tuple(r) for r in only_empty.collect()] == [("", 1)]


def test_path_keys(spark):
    cases = [
        ("REG AIR", "REG_AIR"), ("Brand#12", "Brand_12"), ("a-b_c", "a-b_c"), ("", "__EMPTY__"),
        (None, "__NULL__"), ("café/x", "caf__x"),
    ]
    df = spark.createDataFrame(cases, "k string, folder string")
    rows = df.select(keys.base_path_key(df.schema, ["k"]).alias("found"), "folder").collect()
    assert all(r.found == r.folder for r in rows)


def test_path_keys_of_other_types(spark):
    df = spark.sql(
        "select true as b, date'2024-01-02' as d, timestamp_ntz'2024-01-02 03:04:05.5' as t, "
        "timestamp_ntz'2024-01-02 03:04:05' as u, -3 as i, cast(1.50 as decimal(5,2)) as n, "
        "cast(-0.0 as double) as z, X'CAFE' as x"
    )
    wanted = {
        "b": "True", "d": "2024-01-02", "t": "2024-01-02_03_04_05_500000", "u": "2024-01-02_03_04_05",
        "i": "-3", "n": "1_50", "z": "0_0", "x": "CAFE",
    }
    for name, folder_name in wanted.items():
        assert values(df.select(keys.base_path_key(df.schema, [name]))) == [folder_name], name


def test_long_keys_keep_their_whole_name(spark):
    long = ["x" * 400 + "1", "x" * 400 + "2"]
    df = spark.createDataFrame([(k,) for k in long], "k string")
    assert values(df.select(keys.base_path_key(df.schema, ["k"]))) == long


def test_colliding_keys_get_folders_of_their_own(spark):
    new = spark.createDataFrame([("A B",), ("A#B",), ("A_B",), ("C",), ("__NULL__",), (None,), ("D E",)], "k string")
    taken = spark.createDataFrame([("D_E",)], "path_key string")
    rows = {r.k: r for r in keys.assign_path_keys(new, taken, ["k"]).collect()}
    folders = [r.path_key for r in rows.values()]
    assert len(set(folders)) == len(folders)
    assert rows["C"].path_key == "C"
    assert rows["A B"].path_key.startswith("A_B_") and rows["D E"].path_key != "D_E"
    assert {r.key_count for r in keys.path_collisions(new, ["k"]).collect()} == {2, 3}


@pytest.mark.parametrize(
    "name, stage_path, wanted",
    [
        ("s3://bucket/exports/2026/AIR/data_0.parquet", "exports/2026", "exports/2026/AIR/data_0.parquet"),
        ("azure://acc/x/exports/2026//AIR/data.parquet", "exports/2026", "exports/2026/AIR/data.parquet"),
        # the first occurrence of the whole path counts
        ("s3://b/p/q/p/q/f", "p/q", "p/q/p/q/f"),
        # the path as a whole is absent: the last occurrence of its last segment counts
        ("s3://bucket/2026/other/2026/AIR/f", "exports/2026", "exports/2026/AIR/f"),
        ("s3://bucket/exports/2026/AIR/f", "exports/2026/", "exports/2026/AIR/f"),
        # nothing follows that segment
        ("s3://bucket/other/2026", "exports/2026", "exports/2026"),
        # not found at all
        ("s3://bucket/other/AIR/f.parquet", "exports/2026", "exports/2026/f.parquet"),
        ("local/dir/f.parquet", "exports", "exports/f.parquet"),
        ("local/dir/f.parquet", "", "f.parquet"),
        ("s3://bucket/a/b/f.parquet", "", "f.parquet"),
    ],
)
def test_relative_path(spark, name, stage_path, wanted):
    df = spark.createDataFrame([(name,)], "name string")
    assert values(df.select(paths.relative_path(F.col("name"), stage_path))) == [wanted]


def test_relative_path_keeps_folders_below_the_root(spark):
    df = spark.createDataFrame([("s3://bucket/a/b/f.parquet",)], "name string")
    assert values(df.select(paths.relative_path(F.col("name"), "", "s3://bucket/a"))) == ["b/f.parquet"]


@pytest.mark.parametrize(
    "seconds, wanted",
    [
        (0, "0 seconds"), (1, "1 second"), (60, "1 minute, 0 seconds"), (3661, "1 hour, 1 minute, 1 second"),
        (86400, "1 day, 0 seconds"), (200000, "2 days, 7 hours, 33 minutes, 20 seconds"),
    ],
)
def test_elapsed_text(spark, seconds, wanted):
    assert values(spark.range(1).select(texts.elapsed_text(F.lit(seconds)))) == [wanted]


def test_texts(spark):
    row = spark.sql("select repeat('e', 900) as e, 'short' as s, repeat('x', 31) as x, cast(null as string) as n").select(
        F.length(texts.clip_error(F.col("e"))).alias("clipped"),
        texts.fallback_message(F.col("s")).alias("fallback"),
        texts.both_failed_message(F.col("s")).alias("both"),
        texts.shortened(F.col("x")).alias("cut"),
        texts.shown(F.col("n"), "N/A").alias("blank"),
    ).first()
    assert row.clipped == 500
    assert row.fallback == "ADD_FILES_COPY failed: short. Retrying with FULL_INGEST..."
    assert row.both == "short (after ADD_FILES_COPY fallback)"
    assert row.cut == "x" * 27 + "..." and row.blank == "N/A"


@pytest.fixture
def awkward(spark):
    return spark.sql(
        "select timestamp'2024-03-01 12:00:00.123456' as ltz, timestamp_ntz'2024-03-01 12:00:00' as ntz, "
        "cast('10:11:12.5' as time) as clock, parse_json('{\"b\": [1, 2], \"a\": null}') as v, "
        "named_struct('ts', timestamp'2024-03-01 12:00:00', 'offset', '+05:30') as tz, "
        "array(timestamp'2024-03-01 12:00:00') as many, map('k', parse_json('1')) as m, "
        "named_struct('inner', timestamp'2024-03-01 12:00:00', 'n', 1) as s, cast(null as void) as nothing, "
        "'text' collate UNICODE as c, X'00' as bin, cast(1.5 as float) as f"
    )


def test_compat_projection_keeps_order_and_fits_parquet(awkward, folder):
    out = types.compat_projection(awkward)
    assert out.columns == awkward.columns
    assert dict(out.dtypes) == {
        "ltz": "timestamp_ntz", "ntz": "timestamp_ntz", "clock": "time(6)", "v": "string", "tz": "timestamp_ntz",
        "many": "array<timestamp_ntz>", "m": "map<string,string>", "s": "struct<inner:timestamp_ntz,n:int>",
        "nothing": "string", "c": "string", "bin": "binary", "f": "float",
    }
    out.write.parquet(f"{folder}/out")
    row = out.sparkSession.read.parquet(f"{folder}/out").first()
    assert row.v == '{"a":null,"b":[1,2]}'
    assert row.tz == dt.datetime(2024, 3, 1, 17, 30)
    assert row.ltz == dt.datetime(2024, 3, 1, 12, 0, 0, 123456)


def test_offset_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("select named_struct('ts', timestamp'2024-03-01 12:00:00Z', 'offset', '-03:00') as tz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(types.compat_projection(df)) == [dt.datetime(2024, 3, 1, 9)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_compat_report_counts_columns_and_values(awkward):
    found = {r.data_type: (r.column_count, r.value_count) for r in types.compat_report(awkward, count_values=True).collect()}
    assert found == {
        "TIMESTAMP_LTZ": (1, 1), "TIMESTAMP_NTZ": (1, 1), "TIMESTAMP_TZ": (1, 1), "TIME": (1, 1), "VARIANT": (1, 1),
    }
    assert types.compat_report(awkward.select("bin")).count() == 0


def test_geometries_are_exported_as_wkb(spark, folder):
    point = "X'0101000000000000000000F03F0000000000000040'"
    with session_setting(spark, "spark.sql.geospatial.enabled", "true"):
        df = spark.sql(f"select st_geogfromwkb({point}) as g, st_geomfromwkb({point}) as m")
        assert [types.source_type_name(f.dataType) for f in df.schema] == ["GEOGRAPHY", "GEOMETRY"]
        types.compat_projection(df).write.parquet(f"{folder}/out")
        row = spark.read.parquet(f"{folder}/out").first()
    assert row.g == row.m and len(row.g) == 21
    assert {f.dataType.simpleString() for f in types.target_schema(df.schema)} == {"binary"}


def test_projection_has_no_python_step(awkward):
    plan = types.compat_projection(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_target_schema_and_binding_by_exact_name(spark):
    source = spark.createDataFrame([(1, 2.5, "x", 9)], "id int, price float, NAME string, extra int")
    schema = types.target_schema(T.StructType.fromDDL("id int, price float, name string, added date"))
    assert [f.dataType.simpleString() for f in schema] == ["int", "double", "string", "date"]
    bound = types.bind_by_name(source, schema)
    assert [tuple(r) for r in bound.collect()] == [(1, 2.5, None, None)]
    decimals = types.target_schema(T.StructType.fromDDL("a tinyint, b bigint, c array<int>"), integers="decimal")
    assert [f.dataType.simpleString() for f in decimals] == ["decimal(38,0)", "decimal(38,0)", "array<decimal(38,0)>"]


def test_nested_fields_are_bound_by_name(spark):
    source = spark.sql("select named_struct('b', 2, 'a', 'x') as s, array(named_struct('n', 1)) as many")
    schema = T.StructType.fromDDL("s struct<a:string,b:bigint,c:date>, many array<struct<n:double>>")
    bound = types.bind_by_name(source, schema)
    assert bound.schema.simpleString() == schema.simpleString()
    row = bound.first()
    assert tuple(row.s) == ("x", 2, None) and row.many[0].n == 1.0


def test_row_bytes(spark):
    df = spark.sql("select 'ab' as s, cast(null as string) as n, 1 as i, 2L as l, array(1L, 2L) as a, date'2024-01-01' as d")
    assert values(df.select(types.row_bytes(df.schema))) == [2 + 0 + 4 + 8 + 16 + 4]


def test_columns_of_a_schema(spark, awkward):
    listed = describe_columns(spark, awkward.select("ltz", "v", "bin").schema)
    assert [tuple(r) for r in listed.orderBy("ordinal").collect()] == [
        (0, "ltz", "TIMESTAMP_LTZ", "timestamp_ntz"), (1, "v", "VARIANT", "string"), (2, "bin", "BINARY", "binary"),
    ]
    assert values(column_list(listed)) == ["ltz, v, bin"]
    with pytest.raises(ValueError, match="nope"):
        select_columns(awkward, ["v", "nope"])


def test_catalog_tables(spark):
    spark.sql("create database if not exists shop")
    spark.range(3).write.mode("overwrite").saveAsTable("shop.three")
    try:
        found = catalog_tables(spark, "shop")
        assert Counter({n: t.count() for n, t in found.items()}) == Counter({"three": 3})
    finally:
        spark.sql("drop database shop cascade")
