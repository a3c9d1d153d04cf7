"""Source tables: scans with an explicit column list, column metadata, inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartage.functions.types import export_schema, quoted, source_type_name


def select_columns(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """An explicit export list, checked by exact name; ``None`` keeps every column."""
    if columns is None:
        return df
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"columns not in the table: {', '.join(unknown)}")
    return df.select(*[F.col(quoted(c)) for c in columns])


def describe_columns(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per column: position, name, source type and the type it is exported as."""
    exported = export_schema(schema, spark)
    rows = [
        (i, f.name, source_type_name(f.dataType), exported[i].dataType.simpleString())
        for i, f in enumerate(schema)
    ]
    return spark.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, export_type string"
    )


def column_list(columns: DataFrame, *group: str, name: str = "column_name") -> DataFrame:
    """Ordered column list per group, e.g. per table or per staged file."""
    listed = F.expr(f"listagg({name}, ', ') within group (order by ordinal)").alias("column_list")
    return columns.groupBy(*group).agg(listed)


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table of a schema in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("total_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            "total_rows",
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def catalog_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The tables of one catalog database, by name."""
    return {
        t.name: spark.table(f"{quoted(database)}.{quoted(t.name)}")
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    }
