"""Session settings, scratch folders and the size checks used before a broadcast."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings a migration session should carry. AQE coalesces, splits skewed joins and
# splits rebalanced partitions; the writer limit lets a task that holds only a
# few folders write them without sorting first.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# sources that cannot tell their size report one near the largest long
_UNKNOWN_SIZE = 1 << 60


def local_session(
    app: str = "cartage", cores: str = "*", shuffle_partitions: int = 8, java_options: str = ""
) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if java_options:
        builder = builder.config("spark.driver.extraJavaOptions", java_options)
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, else one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.scratch"


def scratch(spark: SparkSession, label: str) -> str:
    """A folder of its own for one run."""
    return f"{work_root(spark)}/cartage/{label}-{uuid.uuid4().hex[:12]}"


def qualify(spark: SparkSession, uri: str) -> str:
    """``uri`` with its scheme, the form in which file listings report paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    return path.getFileSystem(hadoop_conf).makeQualified(path).toString().rstrip("/")


def literal_path(path: str) -> str:
    """``path`` for a Spark reader, which would take ``*?[]{}`` as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def scanned_bytes(df: DataFrame) -> int | None:
    """Size of the files that a plan reads; ``None`` if a source does not know its size."""
    leaves, read = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator(), 0
    while leaves.hasNext():
        read += int(leaves.next().stats().sizeInBytes())
    return read if read < _UNKNOWN_SIZE else None


def path_exists(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def create_file(spark: SparkSession, uri: str) -> bool:
    """Create an empty file; ``False`` if there is one already."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    filesystem = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if filesystem.exists(path):
        return False
    try:
        filesystem.create(path, False).close()
    except Py4JJavaError as refused:
        # the store's own check decides between writers that passed the first one together
        if filesystem.exists(path):
            return False
        raise refused
    return True


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """A small file, whole or not at all where the store renames atomically."""
    path, draft = spark._jvm.org.apache.hadoop.fs.Path(uri), spark._jvm.org.apache.hadoop.fs.Path(f"{uri}.{uuid.uuid4().hex}")
    filesystem = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = filesystem.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not filesystem.rename(draft, path):
        filesystem.delete(draft, False)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a Hadoop glob pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def materialize(df: DataFrame, uri: str) -> DataFrame:
    """Write ``df`` once and hand back the written table (cuts lineage, survives lost executors)."""
    df.write.mode("overwrite").parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(literal_path(uri))


def one_row(spark: SparkSession, **values) -> DataFrame:
    """A single-row frame built on the JVM side."""
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in values.items()])


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str):
    """A runtime setting for the jobs inside; the session's own value comes back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
