"""Full load: snapshot a table in ranges, resumable."""

from __future__ import annotations

import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from changelake.functions.casts import conform
from changelake.functions.types import Field
from changelake.operators.progress import STREAM_SCHEMA
from changelake.operators.records import add_cdc_metadata, enforce_required, fail_on_rejects
from changelake.plans.config import Destination
from changelake.plans.progress_store import ProgressStore
from changelake.session import small_frame

# Ranges that are read, written and recorded together. Many, so that one wave fills a cluster.
CHUNKS_PER_WAVE = 2000


def full_load(
    spark: SparkSession,
    source,
    table: str,
    fields: list[Field],
    destination: Destination,
    destination_table: str,
    store: ProgressStore,
    ingest_ts: datetime.datetime,
    chunks_per_wave: int = CHUNKS_PER_WAVE,
) -> int:
    """Load what is not loaded yet; returns the number of ranges read.

    Each wave of ranges is one Spark job whose tasks read, cast and write. Progress is saved
    after each wave, and a wave that is repeated replaces its own files.
    """
    saved = store.load(spark).streams.filter(F.col("stream_id") == table).first()
    done = (saved.full_load_chunks_done or 0) if saved else 0
    total = (saved.full_load_chunks_total or 0) if saved else 0
    # A resumed load keeps the ranges it began with; later rows fall into the open last one.
    listing = f"{store.folder(spark)}/load/{table}"
    ranges = source.ranges(spark, table, fields, total if done else None, listing)
    generation = store.generation(spark)
    read = 0
    for first in range(done, ranges.count, chunks_per_wave):
        last = min(first + chunks_per_wave, ranges.count) - 1
        rows = conform(ranges.read(first, last), fields)
        rows = fail_on_rejects(enforce_required(rows, fields))
        rows = rows.withColumn("_cdc_position", F.lit(0).cast("bigint"))
        rows = add_cdc_metadata(rows, F.lit("SNAPSHOT"), F.lit(ingest_ts))
        batch_id = f"load-{generation}-{first:010d}"
        destination.write_batch(rows, destination_table, batch_id, ingest_ts.date())
        completed = last == ranges.count - 1
        update = [
            (table, "full_load", None, None, completed, last + 1, ranges.count, ingest_ts)
        ]
        store.update(spark, streams=small_frame(spark, update, STREAM_SCHEMA))
        read += last - first + 1
    return read
