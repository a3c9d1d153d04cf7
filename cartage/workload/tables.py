"""Given tables, and log-shaped data that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartage.functions.keys import base_path_key
from cartage.functions.texts import fallback_message, run_name
from cartage.functions.types import compat_columns
from cartage.operators.export import write_partitions
from cartage.plans.profile import daily
from cartage.session import session_setting

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

KEYS = ["task_id", "item_id"]

# fixed values: the points (1 2) and (3 4) in well-known binary form
POINT_1_2 = "0101000000000000000000F03F0000000000000040"
POINT_3_4 = "010100000000000000000008400000000000001040"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(table(spark, sf_dir, "events"), F.col("ts"))


def file_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream read as transitions of an import log."""
    return _history(spark, sf_dir, {
        "view": "PENDING", "click": "IN_PROGRESS", "purchase": "SUCCESS",
        "error": "FAILED", "signup": "RETRYING_FULL_INGEST",
    })


def partition_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream read as transitions of an export log."""
    return _history(spark, sf_dir, {
        "view": "PENDING", "click": "IN_PROGRESS", "purchase": "COMPLETED",
        "error": "FAILED", "signup": "NOT_SELECTED",
    })


def _history(spark: SparkSession, sf_dir: str, states: dict[str, str]) -> DataFrame:
    status = F.create_map(*[F.lit(x) for pair in states.items() for x in pair])[F.col("event_type")]
    problem = F.repeat(F.concat_ws(" ", "event_type", "props", F.lit("")), 60)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("task_id"),
        (F.col("event_id") % 20).alias("item_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("at"),
        status.alias("status"),
        F.when(F.col("value") < 20, "ADD_FILES_COPY").otherwise("FULL_INGEST").alias("load_mode_used"),
        F.when(F.col("event_type") == "error", problem)
        .when((F.col("event_type") == "purchase") & (F.col("value") >= 20), fallback_message(F.col("props")))
        .alias("error_message"),
        F.variant_get(F.parse_json("props"), "$.k", "int").alias("retry_count"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as a registry of runs."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    operation = F.when(urgent, "import").otherwise("export")
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "RUNNING")
    return table(spark, sf_dir, "orders").select(
        run_name(
            "migrate", operation, F.lit("shop"), F.lit("sales"),
            F.concat(F.lit("order"), F.col("o_orderkey").cast("string")),
            at=F.col("o_orderdate"),
        ).alias("task_id"),
        F.upper(operation).alias("operation"),
        status.otherwise("FAILED").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


def stage(df: DataFrame, keys: list[str], stage_uri: str, max_records_per_file: int = 0) -> None:
    """Write a whole table as staged files, one folder per key, without a log."""
    rows = df.select(*compat_columns(df.schema), base_path_key(df.schema, keys).alias("path_key"))
    write_partitions(rows.repartition("path_key"), stage_uri, max_records_per_file)


def stage_mixed_orders(spark: SparkSession, sf_dir: str, stage_uri: str) -> None:
    """All orders, staged by status: finished ones fit the table, open ones carry
    millisecond timestamps, the rest a price that no cast turns into a number."""
    orders = table(spark, sf_dir, "orders")
    orders.filter("o_orderstatus = 'F'").write.parquet(f"{stage_uri}/fit")
    with session_setting(spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MILLIS"):
        with_millis = orders.filter("o_orderstatus = 'O'").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
        with_millis.write.parquet(f"{stage_uri}/millis")
    other = orders.filter("o_orderstatus not in ('F', 'O')").withColumn("o_totalprice", F.array("o_totalprice"))
    other.write.parquet(f"{stage_uri}/array")
