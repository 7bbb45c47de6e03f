"""Incremental ingestion of action logs with Structured Streaming.

New log files are picked up as they land and every parsed action is appended, however late it comes: the stream
keeps no watermark and drops nothing.  Repeats (the same user, item, action and day, reported again in any later
file) are removed when the merged log is read or written, so the answer does not depend on how the files are cut or
in which order they arrive.  ``foreachBatch`` hands every micro-batch to the batch operators under its batch id.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcast.functions import columns as X
from reelcast.session import shared_folder

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
# FIXED VALUES: event type -> action of the merged log
ACTION_OF = {"click": "click", "purchase": "top", "view": "play"}


def read_action_stream(spark: SparkSession, folder: str, glob: str = "events*.parquet",
                       schema: str = EVENT_SCHEMA, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def parse_actions(events: DataFrame) -> DataFrame:
    """Event rows -> (user_id, movie_id, action, ymd, ts, value); non-actions dropped."""
    action = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in ACTION_OF.items()])
    return (events.select("user_id", X.json_long("props", "$.k").alias("movie_id"), action.alias("action"),
                          X.day_epoch("ts").alias("ymd"), F.col("ts").cast("timestamp").alias("ts"), "value")
            .where(F.col("action").isNotNull() & F.col("movie_id").isNotNull() & F.col("user_id").isNotNull()))


KEYS = ["user_id", "movie_id", "action", "ymd"]


def dedupe_actions(actions: DataFrame) -> DataFrame:
    """One row per (user, item, action, day) of a batch table of appended actions."""
    return actions.select(*KEYS).dropDuplicates()


def run_available_now(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet"):
    """Process everything available now, then stop (scheduled incremental run)."""
    q = (df.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def foreach_batch_merge(target: str):
    """``foreachBatch`` sink appending each micro-batch to ``target`` under a
    folder named by its batch id: a retried batch overwrites its own folder,
    so the sink is exactly-once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(target, f"batch={batch_id}"))
    return write


def ingest_actions(spark: SparkSession, folder: str, out_root: str | None = None,
                   max_files: int | None = None) -> DataFrame:
    """Ingest all files of ``folder`` (at most ``max_files`` per trigger) and return the merged log: the stream's
    appended rows read back as a batch table, repeats removed."""
    root = out_root or f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"
    sink, ckpt = f"{root}/actions", f"{root}/_checkpoint"
    stream = parse_actions(read_action_stream(spark, folder, max_files=max_files))
    run_available_now(stream.select(*KEYS), sink, ckpt)
    return dedupe_actions(spark.read.schema("user_id long, movie_id long, action string, ymd long").parquet(sink))
