"""Structured Streaming landing: API page files -> Bronze -> Silver.

A file-source stream picks up new page documents (JSON lines: one page per
line) as they arrive. Each micro-batch, in ``foreachBatch``:

1. flattens the pages (good rows to Bronze, rejected elements to quarantine);
2. re-normalises exactly the Silver ``_date`` partitions that the batch
   touched: the batch's distinct event days (a calendar-bounded list of
   values) become a static partition filter on Bronze, so only those day
   folders are read, deduplicated with everything already landed for those
   days, and written with dynamic partition overwrite.

Late or re-delivered rows therefore correct their day in Silver on the next
trigger. Each epoch of each stream is a landing of its own, so a second stream or a
fresh checkpoint, whose epochs begin at 0 again, never touches earlier rows, and a
replayed micro-batch replaces its own. Landing times are those of the arrived files,
not of the wall clock, so a replay lands equal rows. Progress is kept in the checkpoint
location, which must be on shared storage.
``trigger(availableNow=True)`` processes everything present and stops, which
turns the same code into an incremental batch job.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import LakePaths, ingest_pages, normalize_days
from ..sources import pages, sinks

ARRIVED = "_arrived_at"


def page_stream(spark: SparkSession, source_dir: str, max_files: int | None = None) -> DataFrame:
    """Streaming frame of page documents (column ``body``) with their file's time."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(source_dir).select(
        F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias(ARRIVED)
    )


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id a stream keeps over restarts, from its checkpoint; a fresh checkpoint has
    a new one. Written before the first micro-batch runs."""
    return json.loads(sinks.read_texts(spark, checkpoint_location)["metadata"])["id"]


def renormalize_dates(spark: SparkSession, paths: LakePaths, dates: list) -> dict:
    """Rebuild the Silver partitions that the given event dates affect.

    ``dates`` is a list of ``datetime.date`` (``None`` for rows without an
    event time). As literal values they are a static partition filter, so only
    those day folders of Bronze are read (a join with a frame of dates would not
    be pruned: dynamic pruning needs a selective filter on the other side).
    """
    return normalize_days(spark, paths, dates)


def process_batch(
    batch: DataFrame,
    epoch_id: int,
    paths: LakePaths,
    stream: str,
    secret: str | bytes | None = None,
    ingested_at: datetime | str | None = None,
    tokenize: bool = True,
) -> None:
    """Land one micro-batch of the stream named ``stream``, with phones tokenised unless
    that is turned off. Rows without a landing time of their file need ``ingested_at``."""
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        if batch.isEmpty():
            return
        if ingested_at is None:
            newest = F.max(F.col(ARRIVED)).cast("timestamp_ntz")
            ingested_at = batch.agg(F.convert_timezone(F.current_timezone(), F.lit("UTC"), newest)).first()[0]
        landing = f"stream-{stream}-{epoch_id:08d}"
        landed = ingest_pages(batch.select("body"), paths, ingested_at, landing, secret, tokenize=tokenize)
        # distinct event days of the batch: a handful of values, one per day
        renormalize_dates(spark, paths, landed["event_days"])
    finally:
        batch.unpersist()


def start_landing(
    spark: SparkSession,
    source_dir: str,
    paths: LakePaths,
    checkpoint_location: str,
    secret: str | bytes | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files: int | None = None,
    tokenize: bool = True,
) -> StreamingQuery:
    """Start the landing stream (``availableNow`` by default); phones are tokenised with
    ``secret`` unless ``tokenize`` is turned off."""
    pages.token_secret(secret, tokenize)
    writer = (
        page_stream(spark, source_dir, max_files)
        .writeStream.foreachBatch(
            lambda df, eid: process_batch(
                df, eid, paths, stream_id(spark, checkpoint_location), secret, tokenize=tokenize
            )
        )
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
