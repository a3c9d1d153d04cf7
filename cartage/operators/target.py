"""The target table: Parquet files plus a manifest.

Layout: ``<base>/data/load_id=<id>/`` for files a load wrote or copied,
``<base>/metadata/`` for the logs, any other folder for files registered in
place. Only what the file log lists as SUCCESS is part of the table, so a load
that crashed half way stays invisible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartage.operators.logs import StateLog, file_log, run_log, with_status
from cartage.session import literal_path, qualify

# Load modes, and folders below the base that hold no registered files.
FULL_INGEST = "FULL_INGEST"
ADD_FILES_COPY = "ADD_FILES_COPY"
ADD_FILES_REFERENCE = "ADD_FILES_REFERENCE"
LOAD_MODES = (FULL_INGEST, ADD_FILES_COPY, ADD_FILES_REFERENCE)
RESERVED_FOLDERS = ("data", "metadata")


class Target:
    """A target table at a base URI with a fixed schema."""

    def __init__(self, spark: SparkSession, base_uri: str, schema: T.StructType):
        self.spark = spark
        self.base_uri = qualify(spark, base_uri)
        self.schema = schema

    @property
    def files(self) -> StateLog:
        return file_log(self.spark, f"{self.base_uri}/metadata/files")

    @property
    def runs(self) -> StateLog:
        return run_log(self.spark, f"{self.base_uri}/metadata/runs")

    def load_folder(self, load_id: str) -> str:
        return f"{self.base_uri}/data/load_id={load_id}"


def read_target(target: Target) -> DataFrame:
    """The rows of every successfully loaded file."""
    spark = target.spark
    loaded = with_status(target.files.current(), "SUCCESS")
    # copied and registered files count one by one; an ingest is one folder, whatever number of files it holds
    in_place = F.col("load_mode_used").isin(ADD_FILES_COPY, ADD_FILES_REFERENCE)
    folders = [r[0] for r in loaded.filter(~in_place).select("target_path").distinct().collect()]
    paths = folders + _registered_paths(spark, loaded.filter(in_place).select("target_path"))
    if not paths:
        return spark.createDataFrame([], target.schema)
    reader = spark.read.schema(target.schema).option("recursiveFileLookup", "true")
    return reader.parquet(*[literal_path(p) for p in paths])


def _registered_paths(spark: SparkSession, registered: DataFrame) -> list[str]:
    """Paths that cover the registered files: whole folders where every file in
    the folder is registered, single files elsewhere."""
    parent = F.regexp_replace("target_path", "/[^/]*$", "")
    by_folder = registered.select(parent.alias("folder"), "target_path")
    folders = [r[0] for r in by_folder.select("folder").distinct().collect()]
    if not folders:
        return []
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        [literal_path(f) for f in folders]
    )
    present = listed.select(F.col("path").alias("target_path")).distinct()
    unregistered = present.join(registered, "target_path", "left_anti").select("target_path")
    # a stray file spoils its own folder and every folder above it
    spoiled = {r[0] for r in unregistered.select(parent.alias("folder")).distinct().collect()}
    above = {stray[:at] for stray in spoiled for at in range(len(stray)) if stray[at] == "/"}
    mixed = [f for f in folders if f in spoiled or f in above]
    whole = sorted(set(folders) - set(mixed))
    topmost = _without_nested(whole)
    if not mixed:
        return topmost
    # a mixed folder below a whole one cannot be: its stray file would have spoiled that one too
    named = spark.createDataFrame([(f,) for f in mixed], "folder string")
    single = by_folder.join(named, "folder", "left_semi").select("target_path")
    return topmost + [r[0] for r in single.collect()]


def _without_nested(folders: list[str]) -> list[str]:
    kept: list[str] = []
    for folder in sorted(folders, key=lambda f: f + "/"):
        if not kept or not folder.startswith(kept[-1] + "/"):
            kept.append(folder)
    return kept
