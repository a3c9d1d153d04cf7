"""Staged files: listing, checksums and Parquet footers.

Listing is Spark's own file index. Footers and checksums are read by the
executors, one file at a time, in bounded memory; only metadata comes back.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartage.session import literal_path, path_exists, qualify

# the per-file helpers below travel with their job: executors need no install of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "path string, length bigint, modification_time timestamp"
_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
_COLUMN = "struct<name:string,type:string,unit:string>"
FOOTERS = f"path string, length bigint, num_rows bigint, columns array<{_COLUMN}>, error string"
_CHUNK = 8 * 1024 * 1024


def list_files(spark: SparkSession, uri: str) -> DataFrame:
    """Every non-hidden file below ``uri``; the content column is pruned, so no file is opened."""
    if not path_exists(spark, uri):
        return spark.createDataFrame([], LISTING)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        literal_path(qualify(spark, uri))
    )
    return listed.select("path", "length", F.col("modificationTime").alias("modification_time"))


def stream_files(spark: SparkSession, uri: str, max_files: int | None = None) -> DataFrame:
    """The same listing as a stream: each file shows up once, when it first appears."""
    reader = (
        spark.readStream.schema(_BINARY_FILE)
        .format("binaryFile")
        .option("recursiveFileLookup", "true")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    listed = reader.load(literal_path(qualify(spark, uri)))
    return listed.select("path", "length", F.col("modificationTime").alias("modification_time"))


def files_only(listing: DataFrame) -> DataFrame:
    """Without folder markers and empty files."""
    return listing.filter("length > 0")


def spread(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Deal the rows out over the cluster: the work behind each file is long, the rows are few."""
    return files.repartition(tasks or files.sparkSession.sparkContext.defaultParallelism)


def open_file(path: str):
    """File system and path of a Hadoop-style URI, for code that runs inside a task."""
    from pyarrow import fs

    uri = path
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:/"):].lstrip("/")
    if uri.startswith("file://"):
        return fs.LocalFileSystem(), uri[len("file://"):]
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://"):]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def with_md5(listing: DataFrame) -> DataFrame:
    """Listing plus an MD5 of each file, streamed in chunks."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            sums = []
            for path in batch["path"]:
                filesystem, name = open_file(path)
                md5 = hashlib.md5()
                with filesystem.open_input_stream(name) as stream:
                    while chunk := stream.read(_CHUNK):
                        md5.update(chunk)
                sums.append(md5.hexdigest())
            yield batch.assign(md5=sums)

    return spread(listing).mapInPandas(digest, f"{LISTING}, md5 string")


def _type_name(arrow_type) -> str:
    """Spark's name for a Parquet column as pyarrow reports it."""
    import pyarrow as pa

    t = pa.types
    if t.is_dictionary(arrow_type):
        return _type_name(arrow_type.value_type)
    simple = (
        (t.is_boolean, "boolean"),
        (t.is_int8, "tinyint"),
        (t.is_int16, "smallint"),
        (t.is_int32, "int"),
        (t.is_int64, "bigint"),
        (t.is_uint8, "smallint"),
        (t.is_uint16, "int"),
        (t.is_uint32, "bigint"),
        (t.is_uint64, "decimal(20,0)"),
        (t.is_float32, "float"),
        (t.is_float64, "double"),
        (t.is_date, "date"),
        (t.is_time, "time(6)"),
        (t.is_string, "string"),
        (t.is_large_string, "string"),
        (t.is_binary, "binary"),
        (t.is_large_binary, "binary"),
        (t.is_fixed_size_binary, "binary"),
    )
    for test, name in simple:
        if test(arrow_type):
            return name
    if t.is_decimal(arrow_type):
        return f"decimal({arrow_type.precision},{arrow_type.scale})"
    if t.is_timestamp(arrow_type):
        return "timestamp" if arrow_type.tz else "timestamp_ntz"
    if t.is_list(arrow_type) or t.is_large_list(arrow_type):
        return f"array<{_type_name(arrow_type.value_type)}>"
    if t.is_map(arrow_type):
        return f"map<{_type_name(arrow_type.key_type)},{_type_name(arrow_type.item_type)}>"
    if t.is_struct(arrow_type):
        inner = ",".join(f"{f.name}:{_type_name(f.type)}" for f in arrow_type)
        return f"struct<{inner}>"
    return f"unsupported {arrow_type}"


def _time_unit(arrow_type) -> str | None:
    """Coarsest problem first: MILLIS or NANOS anywhere inside, else MICROS, else none."""
    import pyarrow as pa

    t = pa.types
    if t.is_timestamp(arrow_type) or t.is_time(arrow_type):
        return {"s": "SECONDS", "ms": "MILLIS", "us": "MICROS", "ns": "NANOS"}[arrow_type.unit]
    if t.is_map(arrow_type):
        children = [arrow_type.key_type, arrow_type.item_type]
    elif t.is_list(arrow_type) or t.is_large_list(arrow_type):
        children = [arrow_type.value_type]
    elif t.is_struct(arrow_type):
        children = [f.type for f in arrow_type]
    else:
        return None
    units = [u for u in map(_time_unit, children) if u]
    return next((u for u in units if u != "MICROS"), units[0] if units else None)


def _read_footer(path: str, length: int) -> dict:
    import pyarrow.parquet as pq

    out = {"path": path, "length": length, "num_rows": None, "columns": None, "error": None}
    try:
        filesystem, name = open_file(path)
        with filesystem.open_input_file(name) as handle:
            parquet = pq.ParquetFile(handle)
            # the 12-byte timestamps of old writers look like nanoseconds to pyarrow, but Spark reads them
            int96 = {
                c.path for c in (parquet.schema.column(i) for i in range(len(parquet.schema.names)))
                if c.physical_type == "INT96"
            }
            out["num_rows"] = parquet.metadata.num_rows
            out["columns"] = [
                {
                    "name": f.name,
                    "type": "timestamp" if f.name in int96 else _type_name(f.type),
                    "unit": "INT96" if f.name in int96 else _time_unit(f.type),
                }
                for f in parquet.schema_arrow
            ]
    except Exception as problem:  # a broken file is a finding, not a failed task
        out["error"] = f"{type(problem).__name__}: {problem}"
    return out


def read_footers(listing: DataFrame) -> DataFrame:
    """Rows and physical columns of each file, or the error that makes it unreadable."""

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "length", "num_rows", "columns", "error"]
        for batch in batches:
            rows = [_read_footer(p, n) for p, n in zip(batch["path"], batch["length"])]
            frame = pd.DataFrame(rows, columns=names)
            frame["num_rows"] = frame["num_rows"].astype("Int64")
            yield frame

    return spread(listing.select("path", "length")).mapInPandas(footers, FOOTERS)


def footer_columns(footers: DataFrame) -> DataFrame:
    """One row per column of each file, in file order."""
    return footers.select("path", F.posexplode("columns").alias("ordinal", "column")).select(
        "path",
        "ordinal",
        F.col("column.name").alias("column_name"),
        F.col("column.type").alias("data_type"),
        F.col("column.unit").alias("time_unit"),
    )
