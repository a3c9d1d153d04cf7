"""Partition keys: typed predicates and the folder name of a key.

Keys are never spliced into SQL text. A predicate is a ``Column``; NULL is a key
value like any other, and the empty string differs from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartage.functions.types import quoted

# The pattern of characters a folder name may not hold, and the
# character that stands for each of them.
UNSAFE_CHARACTERS = "[^a-zA-Z0-9_-]"
SUBSTITUTE = "_"

NULL_FOLDER = "__NULL__"
EMPTY_FOLDER = "__EMPTY__"
_SUFFIX_DIGITS = 16

# Types whose values survive the trip to text and back, so that a few selected
# keys may become literals in a pushed-down filter.
LITERAL_TYPES = (
    T.StringType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.BooleanType,
    T.DateType,
    T.TimestampNTZType,
    T.DoubleType,
)


def typed_literal(value, dt: T.DataType) -> Column:
    """``value`` as a literal of the key's own type."""
    if value is not None and not isinstance(value, (str, int, float, bool, bytes)):
        value = str(value)
    return F.lit(value).cast(dt)


def partition_predicate(values: Mapping[str, object], schema: T.StructType) -> Column:
    """Rows of one partition: every key column equals its value, NULL matching NULL."""
    terms = [
        F.col(quoted(name)).eqNullSafe(typed_literal(value, schema[name].dataType))
        for name, value in values.items()
    ]
    return reduce(lambda a, b: a & b, terms)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on null-safe equality of the key columns, as a hash or merge join.

    The right side's keys come out as ``other_key(name)``, so both sides may
    stem from the same table.
    """
    names = set(keys)
    renamed = right.select(
        *[F.col(quoted(c)).alias(other_key(c) if c in names else c) for c in right.columns]
    )
    terms = [F.col(quoted(k)).eqNullSafe(F.col(quoted(other_key(k)))) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, terms), how)


def other_key(name: str) -> str:
    return f"__other_{name}"


def key_ranges(df: DataFrame, selected: DataFrame, keys: Sequence[str]) -> Column | None:
    """What the smallest and largest selected value of each key column say about a row; ``None`` if no key is selected.

    One row of facts reaches the driver, however many keys are selected.
    """
    facts = selected.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            x
            for i, k in enumerate(keys)
            for x in (
                F.min(quoted(k)).cast("string").alias(f"low_{i}"), F.max(quoted(k)).cast("string").alias(f"high_{i}"),
                F.count_if(F.col(quoted(k)).isNull()).alias(f"nulls_{i}"),
            )
        ],
    ).first()
    if not facts["n"]:
        return None
    terms = [F.lit(True)]
    for i, name in enumerate(keys):
        column, dt = F.col(quoted(name)), df.schema[name].dataType
        if not isinstance(dt, LITERAL_TYPES):
            continue
        term = None
        if facts[f"low_{i}"] is not None:
            low, high = (typed_literal(facts[f"{end}_{i}"], dt) for end in ("low", "high"))
            term = (column >= low) & (column <= high)
        if facts[f"nulls_{i}"]:
            term = column.isNull() if term is None else term | column.isNull()
        terms.append(term)
    return reduce(lambda a, b: a & b, terms)


def restrict_to_keys(df: DataFrame, selected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``selected``.

    A semi join for any number of keys, which Spark broadcasts while the key table is small. The range that
    the selected keys span reaches the scan as a filter.
    """
    spanned = key_ranges(df, selected, keys)
    if spanned is None:
        return df.filter(F.lit(False))
    return join_on_keys(df.filter(spanned), selected, keys, "left_semi")


def key_text(column: Column, dt: T.DataType) -> Column:
    """Text of one key value, as it shows in a folder name."""
    if isinstance(dt, T.BooleanType):
        return F.when(column.isNotNull(), F.when(column, "True").otherwise("False"))
    if isinstance(dt, T.BinaryType):
        return F.hex(column)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        # grouping treats -0.0 and 0.0 as one key, so the text must too
        return (column + F.lit(0.0).cast(dt)).cast("string")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        text = column.cast("string")
        return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)
    return column.cast("string")


def sanitized(text: Column) -> Column:
    return F.regexp_replace(text, UNSAFE_CHARACTERS, SUBSTITUTE)


def base_path_key(schema: T.StructType, keys: Sequence[str], parent: str | None = None) -> Column:
    """Folder name of a key before collisions are looked at."""
    parts = []
    for name in keys:
        column = F.col(f"{parent}.{quoted(name)}" if parent else quoted(name))
        text = key_text(column, schema[name].dataType)
        parts.append(
            F.when(text.isNull(), NULL_FOLDER).when(text == "", EMPTY_FOLDER).otherwise(sanitized(text))
        )
    # never shortened: a name the store refuses fails its own partition
    return parts[0] if len(parts) == 1 else F.concat_ws("__", *parts)


def key_digest(schema: T.StructType, keys: Sequence[str], parent: str | None = None) -> Column:
    """Short digest of a key that tells NULL, '' and any text apart."""
    parts = []
    for name in keys:
        column = F.col(f"{parent}.{quoted(name)}" if parent else quoted(name))
        text = key_text(column, schema[name].dataType)
        parts.append(
            F.when(text.isNull(), "N;").otherwise(
                F.concat(F.lit("V"), F.length(text).cast("string"), F.lit(":"), text, F.lit(";"))
            )
        )
    return F.substring(F.sha2(F.concat(*parts), 256), 1, _SUFFIX_DIGITS)


def path_collisions(profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Folder names that several distinct keys would share."""
    return (
        profile.select(base_path_key(profile.schema, keys).alias("path_key"), *[F.col(quoted(k)) for k in keys])
        .distinct()
        .groupBy("path_key")
        .agg(F.count(F.lit(1)).alias("key_count"))
        .filter("key_count > 1")
    )


def assign_path_keys(
    new_keys: DataFrame, taken: DataFrame, keys: Sequence[str], parent: str | None = None
) -> DataFrame:
    """Add ``base_key`` and ``path_key`` to new keys.

    A key keeps the plain folder name unless another new key sanitizes to the
    same name or an earlier run already gave the name away; then a digest of the
    key is appended. ``taken`` holds the ``path_key`` of the keys known so far;
    ``parent`` names the struct that holds the key columns, if one does.
    """
    schema = new_keys.schema[parent].dataType if parent else new_keys.schema
    based = new_keys.withColumn("base_key", base_path_key(schema, keys, parent))
    clashing = (
        based.groupBy("base_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(taken.select(F.col("path_key").alias("base_key"), F.lit(True).alias("used")).distinct(), "base_key", "left")
        .filter("n > 1 or used")
        .select("base_key", F.lit(True).alias("clash"))
    )
    digest = key_digest(schema, keys, parent)
    return based.join(clashing, "base_key", "left").select(
        *[F.col(quoted(c)) for c in new_keys.columns],
        "base_key",
        F.when(F.col("clash"), F.concat("base_key", F.lit("_"), digest))
        .otherwise(F.col("base_key"))
        .alias("path_key"),
    )
