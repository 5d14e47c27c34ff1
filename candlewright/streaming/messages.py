"""New messages as a stream: the same rules as for a batch, written by insert-or-ignore."""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewright.functions.language import Detector
from candlewright.operators.messages import checked_messages, enriched
from candlewright.operators.sinks import MESSAGE_LAYOUT, insert_ignore, stored_messages
from candlewright.schemas import MESSAGES

#: Seconds between two writes of a running stream.
FLUSH_SECONDS = 5


def read_messages(spark: SparkSession, path: str, files_a_trigger: int = 100) -> DataFrame:
    """A stream over a folder of parquet files, or over one file that lies in a folder with others."""
    folder, name = (path, "*.parquet") if os.path.isdir(path) else os.path.split(path)
    options = {"maxFilesPerTrigger": str(files_a_trigger), "pathGlobFilter": name}
    return spark.readStream.schema(MESSAGES).options(**options).parquet(folder)


def start(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    rejects: str | None = None,
    channels: list[str] | None = None,
    keys: list[str] | None = None,
    once: bool = False,
    detector: Detector | None = None,
) -> StreamingQuery:
    """Write the valid messages of a stream to the parquet table ``sink``, and the rejected ones to ``rejects``.

    A message whose key (``id`` unless told otherwise) is stored already is left out, so a replayed batch changes
    nothing. ``once`` takes what is there and stops; else batches follow every few seconds. No message is late. The
    sink is laid out by block of ids, so that a batch reads the blocks it touches. Languages are told by ``detector``.
    """
    if channels is not None:
        stream = stream.where(F.col("channel_name").isin(channels))

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = checked_messages(batch)
        if rejects is not None:
            checked = checked.persist(StorageLevel.MEMORY_AND_DISK)  # for both writes
        at = F.coalesce("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
        valid = checked.where("reject_reason IS NULL").drop("reject_reason")
        stored = lambda rows: stored_messages(enriched(rows, detector), MESSAGES, at)
        insert_ignore(valid, sink, keys or ["id"], ["ingested_at"], layout=MESSAGE_LAYOUT, finish=stored)
        if rejects is not None:
            rejected = checked.where("reject_reason IS NOT NULL")
            rejected.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            checked.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{FLUSH_SECONDS} seconds")).start()
