"""Which types need a cast before they fit Parquet, and what a target table holds.

Everything here is a schema rule that yields ordinary ``Column`` expressions, so
the casts run inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source type names that an export reports as transformed.
TRANSFORMED_TYPES = (
    "TIME",
    "TIMESTAMP_TZ",
    "TIMESTAMP_LTZ",
    "TIMESTAMP_NTZ",
    "VARIANT",
    "GEOGRAPHY",
    "GEOMETRY",
)

# A timestamp that keeps its own UTC offset; Spark has no type for it.
OFFSET_TIMESTAMP = T.StructType(
    [T.StructField("ts", T.TimestampType()), T.StructField("offset", T.StringType())]
)

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
_GEO_TYPES = tuple(getattr(T, n) for n in ("GeographyType", "GeometryType") if hasattr(T, n))
_TIME_TYPES = tuple(getattr(T, n) for n in ("TimeType",) if hasattr(T, n))
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_offset_timestamp(dt: T.DataType) -> bool:
    return isinstance(dt, T.StructType) and [(f.name, f.dataType) for f in dt] == [
        (f.name, f.dataType) for f in OFFSET_TIMESTAMP
    ]


def source_type_name(dt: T.DataType) -> str:
    """The migration vocabulary's name for a Spark type."""
    if is_offset_timestamp(dt):
        return "TIMESTAMP_TZ"
    if isinstance(dt, T.TimestampType):
        return "TIMESTAMP_LTZ"
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP_NTZ"
    if isinstance(dt, T.VariantType):
        return "VARIANT"
    if isinstance(dt, _TIME_TYPES):
        return "TIME"
    if isinstance(dt, _GEO_TYPES):
        return type(dt).__name__.removesuffix("Type").upper()
    return dt.simpleString().upper()


def wall_clock(value: Column) -> Column:
    """Local time of an offset timestamp, independent of the session time zone."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(value["ts"]), F.expr(_EPOCH_NTZ))
    return F.convert_timezone(F.lit("UTC"), value["offset"], utc)


def needs_cast(dt: T.DataType) -> bool:
    if isinstance(dt, (T.TimestampType, T.VariantType, T.NullType, *_GEO_TYPES)):
        return True
    if isinstance(dt, T.StringType):
        return dt != T.StringType()
    if is_offset_timestamp(dt):
        return True
    if isinstance(dt, T.ArrayType):
        return needs_cast(dt.elementType)
    if isinstance(dt, T.MapType):
        return needs_cast(dt.keyType) or needs_cast(dt.valueType)
    if isinstance(dt, T.StructType):
        return any(needs_cast(f.dataType) for f in dt)
    return False


def parquet_value(value: Column, dt: T.DataType) -> Column:
    """``value`` in a form every Parquet reader takes; nested fields included."""
    if not needs_cast(dt):
        return value
    if is_offset_timestamp(dt):
        return wall_clock(value)
    if isinstance(dt, T.TimestampType):
        return value.cast("timestamp_ntz")
    if isinstance(dt, (T.VariantType, T.NullType, T.StringType)):
        return value.cast("string")
    if isinstance(dt, _GEO_TYPES):
        return F.st_asbinary(value)
    if isinstance(dt, T.ArrayType):
        return F.transform(value, lambda x: parquet_value(x, dt.elementType))
    if isinstance(dt, T.MapType):
        return F.map_from_entries(
            F.transform(
                F.map_entries(value),
                lambda e: F.struct(
                    parquet_value(e["key"], dt.keyType).alias("key"),
                    parquet_value(e["value"], dt.valueType).alias("value"),
                ),
            )
        )
    fields = [parquet_value(value.getField(f.name), f.dataType).alias(f.name) for f in dt]
    return F.when(value.isNotNull(), F.struct(*fields))


def compat_columns(schema: T.StructType) -> list[Column]:
    """The Parquet-compatible projection of a whole schema, in column order."""
    return [parquet_value(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in schema]


def compat_projection(df: DataFrame) -> DataFrame:
    return df.select(*compat_columns(df.schema))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def export_schema(schema: T.StructType, spark) -> T.StructType:
    return compat_projection(spark.createDataFrame([], schema)).schema


def compat_report(df: DataFrame, count_values: bool = False) -> DataFrame:
    """Per transformed type: how many columns carry it and, on request, how many values get cast.

    The columns are told from the schema alone. Counting values takes one pass over the transformed
    columns; ``value_count`` is NULL without it.
    """
    by_type: dict[str, list[str]] = {}
    for field in df.schema:
        name = source_type_name(field.dataType)
        if name in TRANSFORMED_TYPES:
            by_type.setdefault(name, []).append(field.name)
    if not by_type:
        return df.sparkSession.createDataFrame(
            [], "data_type string, column_count bigint, value_count bigint"
        )
    if not count_values:
        rows = [(name, len(by_type[name]), None) for name in sorted(by_type)]
        return df.sparkSession.createDataFrame(rows, "data_type string, column_count bigint, value_count bigint")
    totals = []
    for name in sorted(by_type):
        counts = [F.count(F.col(quoted(c))) for c in by_type[name]]
        total = counts[0]
        for extra in counts[1:]:
            total = total + extra
        totals.append(
            F.struct(
                F.lit(name).alias("data_type"),
                F.lit(len(by_type[name])).cast("bigint").alias("column_count"),
                total.alias("value_count"),
            )
        )
    return df.agg(F.array(*totals).alias("rows")).select(F.inline("rows"))


def target_type(dt: T.DataType, integers: str = "keep") -> T.DataType:
    """Type of a lakehouse column: plain strings, doubles, microsecond timestamps.

    ``integers="decimal"`` maps the whole integer family to ``decimal(38,0)``,
    the type under which some warehouses unload every integer.
    """
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType, T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(dt, T.FloatType):
        return T.DoubleType()
    if isinstance(dt, _INTEGERS) and integers == "decimal":
        return T.DecimalType(38, 0)
    if isinstance(dt, T.TimestampType) or is_offset_timestamp(dt):
        return T.TimestampNTZType()
    if isinstance(dt, _GEO_TYPES):
        return T.BinaryType()
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(target_type(dt.elementType, integers), dt.containsNull)
    if isinstance(dt, T.MapType):
        return T.MapType(
            target_type(dt.keyType, integers),
            target_type(dt.valueType, integers),
            dt.valueContainsNull,
        )
    if isinstance(dt, T.StructType):
        return T.StructType(
            [T.StructField(f.name, target_type(f.dataType, integers), f.nullable) for f in dt]
        )
    return dt


def target_schema(schema: T.StructType, integers: str = "keep") -> T.StructType:
    return T.StructType([T.StructField(f.name, target_type(f.dataType, integers)) for f in schema])


def fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as type ``want``; struct fields are matched by name, not by position."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType) and not is_offset_timestamp(have):
        present = {f.name: f.dataType for f in have}
        fields = [
            (fitted(value.getField(f.name), present[f.name], f.dataType) if f.name in present
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: fitted(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.map_from_entries(
            F.transform(
                F.map_entries(value),
                lambda e: F.struct(
                    fitted(e["key"], have.keyType, want.keyType).alias("key"),
                    fitted(e["value"], have.valueType, want.valueType).alias("value"),
                ),
            )
        )
    return parquet_value(value, have).cast(want)


def bind_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` from ``df`` by exact name: missing is NULL, extra is dropped."""
    present = {f.name: f.dataType for f in df.schema}
    out = []
    for field in schema:
        if field.name in present:
            value = fitted(F.col(quoted(field.name)), present[field.name], field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)


_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def value_bytes(value: Column, dt: T.DataType) -> Column:
    """Bytes one value takes: text and binary by length, numbers by width, NULL none."""
    if isinstance(dt, (T.StringType, T.BinaryType)):
        size = F.octet_length(value).cast("bigint")
    elif isinstance(dt, T.DecimalType):
        size = F.when(value.isNotNull(), F.lit(8 if dt.precision <= 18 else 16).cast("bigint"))
    elif type(dt) in _WIDTHS:
        size = F.when(value.isNotNull(), F.lit(_WIDTHS[type(dt)]).cast("bigint"))
    elif isinstance(dt, T.ArrayType) and type(dt.elementType) in _WIDTHS:
        width = _WIDTHS[type(dt.elementType)]
        size = F.when(value.isNotNull(), F.size(value).cast("bigint") * F.lit(width))
    else:
        size = F.octet_length(F.to_json(F.struct(value))).cast("bigint")
    return F.coalesce(size, F.lit(0).cast("bigint"))


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of one row over the columns of ``schema``."""
    total = F.lit(0).cast("bigint")
    for field in schema:
        total = total + value_bytes(F.col(quoted(field.name)), field.dataType)
    return total
