"""A topic streamed to a table."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changelake.functions.types import topic_fields
from changelake.operators.catalog import CDC
from changelake.operators.progress import (
    STREAM_SCHEMA,
    offset_watermark,
    resume_filter,
    starting_offsets,
)
from changelake.operators.records import split_rejects
from changelake.plans.config import (
    CHECKPOINT_INTERVAL_MS,
    CHECKPOINT_RECORDS,
    Destination,
    Stream,
)
from changelake.plans.progress_store import ProgressStore, note_malformed
from changelake.plans.topic_log import only_stream, topic_log
from changelake.session import small_frame
from changelake.sources.topics import topic_stream


def utc_now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def subscribe(
    spark: SparkSession,
    servers: str,
    stream: Stream,
    store: ProgressStore,
    partitions: int,
    start: str = "latest",
    records: int = CHECKPOINT_RECORDS,
    options: dict[str, str] | None = None,
    interval_ms: int = CHECKPOINT_INTERVAL_MS,
) -> DataFrame:
    """The stream's topic from its saved offsets on, a batch for `records` messages at least or each interval."""
    stream_id = f"{stream.source_topic}.{stream.destination}"
    begun = store.start_offsets(spark).filter(F.col("stream_id") == stream_id)
    default = -2 if start == "earliest" else -1
    saved = starting_offsets(begun, stream.source_topic, partitions, default).first()
    return topic_stream(
        spark, servers, stream.source_topic, saved[0] if saved else start, records, options, interval_ms
    )


def topic_cdc(
    messages: DataFrame,
    streams: list[Stream],
    destination: Destination,
    store: ProgressStore,
    clock: Callable[[], datetime.datetime] = utc_now,
    available_now: bool = True,
    interval_ms: int = CHECKPOINT_INTERVAL_MS,
) -> StreamingQuery:
    """Start the stream: each micro-batch is written, then its offsets are saved.

    Rows that lack a required column go to `<table>__rejects`.
    """
    spark = messages.sparkSession
    stream = only_stream(streams)
    stream_id = f"{stream.source_topic}.{stream.destination}"
    fields = topic_fields(stream.payload_columns, stream.normalize_payload)
    has_required = any(not f.nullable for f in fields)
    generation = store.generation(spark)
    begun = store.start_offsets(spark).filter(F.col("stream_id") == stream_id)
    wanted = messages.filter(F.col("topic") == stream.source_topic)
    wanted = resume_filter(wanted, begun)

    def write(batch: DataFrame, number: int) -> None:
        now = clock()
        batch_id = f"cdc-{generation}-{number:010d}"
        batch = batch.persist()
        try:
            counts = stream.normalize_payload and stream.payload_columns and destination.type == "parquet"
            seen = Observation() if counts else None
            good, _ = split_rejects(topic_log(batch, fields, F.lit(now), seen))
            destination.write_batch(good, stream.destination, batch_id, now.date())
            if seen is not None:
                note_malformed(spark, store, stream.destination, batch_id, seen.get)
            _, rejected = split_rejects(topic_log(batch, fields, F.lit(now)))
            if has_required and not rejected.isEmpty():
                destination.write_batch(
                    rejected, f"{stream.destination}__rejects", batch_id, now.date()
                )
            seen = offset_watermark(batch).select(
                F.lit(stream_id).alias("stream_id"), "topic", "partition", "last_offset"
            )
            update = [(stream_id, CDC, None, None, None, None, None, now)]
            store.update(
                spark,
                streams=small_frame(spark, update, STREAM_SCHEMA),
                offsets=seen,
            )
        finally:
            batch.unpersist()

    writer = wanted.writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{store.folder(spark)}/checkpoint-{stream.destination}"
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms} milliseconds").start()
