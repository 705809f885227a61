"""Progress of streams: offsets, positions, chunks, counts.

Offsets are kept one row per (stream_id, topic, partition); streams one row per stream_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.types import OPERATION_COLUMN
from changelake.operators.ordered import BLOCK_WIDTH, row_numbers

STREAM_SCHEMA = (
    T.StructType()
    .add("stream_id", "string")
    .add("sync_mode", "string")
    .add("last_lsn", "string")
    .add("last_position", "long")
    .add("full_load_completed", "boolean")
    .add("full_load_chunks_done", "integer")
    .add("full_load_chunks_total", "integer")
    .add("last_sync_time", "timestamp")
)
OFFSET_SCHEMA = (
    T.StructType()
    .add("stream_id", "string")
    .add("topic", "string")
    .add("partition", "integer")
    .add("last_offset", "long")
)


def offset_watermark(messages: DataFrame) -> DataFrame:
    """The highest offset of each topic partition."""
    return messages.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"))


def resume_filter(messages: DataFrame, offsets: DataFrame, default: int = -1) -> DataFrame:
    """Messages after the saved offset of their partition.

    A partition without a saved offset starts after `default`.
    """
    saved = offsets.select("topic", "partition", "last_offset")
    return (
        messages.join(saved, ["topic", "partition"], "left")
        .filter(F.col("offset") > F.coalesce("last_offset", F.lit(default)))
        .select(messages.columns)
    )


def starting_offsets(
    offsets: DataFrame, topic: str, partitions: int = 0, default: int = -1
) -> DataFrame:
    """Saved offsets as one row of JSON, for the topic source: `{"topic": {"0": next, ...}}`.

    The source wants every partition named; of `partitions` those without a saved offset get
    `default` (-1 latest, -2 earliest). No row where nothing is saved.
    """
    saved = offsets.filter(F.col("topic") == topic)
    every = saved.select(F.explode(F.sequence(F.lit(0), F.lit(partitions))).alias("partition"))
    every = every.filter(F.col("partition") < partitions).unionByName(saved.select("partition"))
    following = every.distinct().join(saved, "partition", "left").select(
        F.col("partition").cast("string").alias("key"),
        F.coalesce(F.col("last_offset") + 1, F.lit(default)).alias("value"),
    )
    # One entry per partition of one topic.
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    return (
        following.groupBy(F.lit(topic).alias("topic"))
        .agg(F.map_from_entries(entries).alias("next"))
        .select(F.to_json(F.create_map("topic", "next")).alias("starting_offsets"))
    )


def checkpoint_batches(
    messages: DataFrame, records: int = 10_000, width: int = BLOCK_WIDTH
) -> DataFrame:
    """Number the batches of `records` messages within each topic partition, from 0."""
    numbered = row_numbers(messages, ["topic", "partition"], "offset", "_row", width)
    batch = F.expr(f"(`_row` - 1) div {int(records)}L")
    return numbered.withColumn("batch", batch).drop("_row")


def merge_offsets(saved: DataFrame, seen: DataFrame) -> DataFrame:
    """Saved offsets brought forward by those seen; partitions not seen keep theirs."""
    keys = ["stream_id", "topic", "partition"]
    return (
        saved.unionByName(seen).groupBy(keys).agg(F.max("last_offset").alias("last_offset"))
    )


def merge_streams(saved: DataFrame, update: DataFrame) -> DataFrame:
    """Upsert the progress of streams; `update` may lack columns it does not change.

    Positions and times never move back, the completed flag never falls.
    """
    old, new = saved.alias("o"), update.alias("n")
    joined = old.join(new, F.col("o.stream_id") == F.col("n.stream_id"), "full_outer")

    def pick(name: str) -> Column:
        if name not in update.columns:
            return F.col(f"o.{name}")
        if name in ("last_position", "last_sync_time", "full_load_completed"):
            return F.greatest(f"o.{name}", f"n.{name}")
        if name == "last_lsn" and "last_position" in update.columns:
            behind = F.col("n.last_position") < F.col("o.last_position")
            lsn = F.when(behind, F.col("o.last_lsn")).otherwise(F.col("n.last_lsn"))
            return F.coalesce(lsn, "o.last_lsn")
        return F.coalesce(f"n.{name}", f"o.{name}")

    return joined.select([pick(name).alias(name) for name in saved.columns])


def load_progress(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Progress of a table load after each chunk: rows so far, chunks done, completed.

    `rows` has `table_name` and `chunk`; `plan` one row per (table_name, chunk). The rows are
    counted first, so the running sum goes over one small row per chunk.
    """
    so_far = (
        Window.partitionBy("table_name").orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy("table_name")
    counted = rows.groupBy("table_name", "chunk").agg(F.count(F.lit(1)).alias("_rows"))
    done = F.col("chunk") + 1
    return (
        plan.select("table_name", "chunk")
        .join(counted, ["table_name", "chunk"], "left")
        .withColumn("chunk_rows", F.coalesce("_rows", F.lit(0)))
        .withColumn("rows_so_far", F.sum("chunk_rows").over(so_far))
        .withColumn("chunks_total", F.count(F.lit(1)).over(whole))
        .select(
            "table_name",
            "chunk",
            "chunk_rows",
            "rows_so_far",
            done.cast("bigint").alias("chunks_done"),
            "chunks_total",
            (done == F.col("chunks_total")).alias("completed"),
            (done % 10 == 0).alias("flush"),
        )
    )


def sync_counts(changes: DataFrame) -> DataFrame:
    """Records per table and operation."""
    return changes.groupBy("table_name", OPERATION_COLUMN).agg(
        F.count(F.lit(1)).alias("records")
    )
