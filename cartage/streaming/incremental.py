"""Pick up new staged files as they appear.

The stream carries the *listing* of the stage, not its rows: each micro-batch is
a set of new files that goes through the same inspection, load modes and fallback
as a one-off import. The checkpoint remembers which files were seen. A batch's load is
named after the checkpoint and the batch, so a batch that is run again after a crash goes on
where it broke off, and one that had finished loads nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cartage.operators.load import import_files
from cartage.operators.target import FULL_INGEST, Target
from cartage.session import qualify
from cartage.sources.files import stream_files


def batch_name(spark: SparkSession, checkpoint_uri: str, batch_id: int) -> str:
    """The name of a batch's load: the same whenever the batch is run."""
    return f"STREAM_{hashlib.sha256(qualify(spark, checkpoint_uri).encode()).hexdigest()[:16].upper()}_{batch_id}"


def import_stream(
    spark: SparkSession,
    stage_uri: str,
    target: Target,
    checkpoint_uri: str,
    *,
    load_mode: str = FULL_INGEST,
    stage_path: str = "",
    max_files_per_batch: int | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
    takeover: bool = False,
) -> StreamingQuery:
    """Start the import; with ``available_now`` it stops once the stage is drained.

    Another run that is still at work on the target makes the batch fail, unless ``takeover`` says that it is dead.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        own = Target(session, target.base_uri, target.schema)
        import_files(
            session, stage_uri, own, load_mode=load_mode, stage_path=stage_path, files=batch,
            task_id=batch_name(session, checkpoint_uri, batch_id), takeover=takeover, repeatable=True,
        )

    writer = (
        stream_files(spark, stage_uri, max_files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_uri)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
