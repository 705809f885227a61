"""Progress kept as small versioned tables.

    <path>/g=<generation>/v=<version>/{streams,offsets}   and a marker `_COMMITTED`, written last

A version counts once its marker exists, so a reader sees the old or the new progress and never
half of one. No rename is needed, which object stores do not do atomically.
"""

from __future__ import annotations

import threading
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.functions.positions import parse_lsn
from changelake.operators.progress import (
    OFFSET_SCHEMA,
    STREAM_SCHEMA,
    merge_offsets,
    merge_streams,
)
from changelake.session import small_frame
from changelake.sinks import folders

# Position that holds for all streams together.
GLOBAL = "_global"
KEPT_VERSIONS = 5


class Progress(NamedTuple):
    streams: DataFrame
    offsets: DataFrame


def empty_progress(spark: SparkSession) -> Progress:
    """Progress of a source that was never read."""
    return Progress(
        small_frame(spark, [], STREAM_SCHEMA), small_frame(spark, [], OFFSET_SCHEMA)
    )


class ProgressStore:
    """The progress of one sync; one job at a time writes to it, from several threads if need be."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self._updating = threading.Lock()

    def generation(self, spark: SparkSession) -> int:
        """Counts the full refreshes."""
        return max(folders.numbered(spark, self.path, "g="), default=0)

    def folder(self, spark: SparkSession) -> str:
        """Folder of the current generation, for everything that a full refresh drops."""
        return f"{self.path}/g={self.generation(spark)}"

    def _versions(self, spark: SparkSession, folder: str) -> list[int]:
        return [
            v for v in folders.numbered(spark, folder, "v=")
            if folders.exists(spark, f"{folder}/v={v}/_COMMITTED")
        ]

    def load(self, spark: SparkSession) -> Progress:
        """The saved progress, empty if there is none."""
        folder = self.folder(spark)
        versions = self._versions(spark, folder)
        if not versions:
            return empty_progress(spark)
        at = f"{folder}/v={versions[-1]}"
        return Progress(
            spark.read.schema(STREAM_SCHEMA).parquet(f"{at}/streams"),
            spark.read.schema(OFFSET_SCHEMA).parquet(f"{at}/offsets"),
        )

    def save(self, spark: SparkSession, progress: Progress) -> int:
        """Write a new version and make it the current one."""
        folder = self.folder(spark)
        taken = folders.numbered(spark, folder, "v=")
        version = max(taken, default=-1) + 1
        at = f"{folder}/v={version}"
        progress.streams.write.mode("overwrite").parquet(f"{at}/streams")
        progress.offsets.write.mode("overwrite").parquet(f"{at}/offsets")
        folders.touch(spark, f"{at}/_COMMITTED")
        for old in self._versions(spark, folder)[:-KEPT_VERSIONS]:
            folders.remove(spark, f"{folder}/v={old}")
        return version

    def update(
        self,
        spark: SparkSession,
        streams: DataFrame | None = None,
        offsets: DataFrame | None = None,
    ) -> None:
        """Merge what is new into the saved progress."""
        with self._updating:
            saved = self.load(spark)
            self.save(
                spark,
                Progress(
                    saved.streams if streams is None else merge_streams(saved.streams, streams),
                    saved.offsets if offsets is None else merge_offsets(saved.offsets, offsets),
                ),
            )

    def reset(self, spark: SparkSession) -> None:
        """Full refresh: start a new generation with empty progress."""
        following = self.generation(spark) + 1
        folders.touch(spark, f"{self.path}/g={following}/_STARTED")

    def start_offsets(self, spark: SparkSession) -> DataFrame:
        """The offsets this generation began with; fixed by the first call.

        A batch that is repeated must not be cut by offsets it saved itself, so the resume
        filter of a stream uses these and leaves the rest to the checkpoint.
        """
        at = f"{self.folder(spark)}/start_offsets"
        if not folders.exists(spark, f"{at}/_SUCCESS"):
            self.load(spark).offsets.write.mode("overwrite").parquet(at)
        return spark.read.schema(OFFSET_SCHEMA).parquet(at)


MALFORMED = "table_name string, batch_id string, column_name string, records bigint"


def note_malformed(spark: SparkSession, store: ProgressStore, table: str, batch_id: str, counts: dict[str, int]) -> None:
    """Keep the counts of malformed values of a batch; the same batch again replaces them."""
    rows = [(table, batch_id, c, n) for c, n in sorted(counts.items()) if n and c != "_rows"]
    at = f"{store.folder(spark)}/malformed/{table}/batch={batch_id}"
    if rows:
        small_frame(spark, rows, MALFORMED).coalesce(1).write.mode("overwrite").parquet(at)
    elif folders.exists(spark, at):
        folders.remove(spark, at)


def malformed(spark: SparkSession, store: ProgressStore, table: str) -> DataFrame:
    """Malformed values by batch and column of a destination table, those that became null."""
    at = f"{store.folder(spark)}/malformed/{table}"
    if not folders.names(spark, at):
        return small_frame(spark, [], MALFORMED)
    return spark.read.schema(MALFORMED).parquet(f"{at}/*")


STATE_JSON = (
    "streams map<string, struct<sync_mode: string, last_lsn: string, "
    "full_load_completed: boolean, full_load_chunks_done: int, full_load_chunks_total: int, "
    "last_sync_time: timestamp, kafka_offsets: map<string, map<string, bigint>>>>, "
    "global_lsn string"
)


def read_state_json(spark: SparkSession, path: str) -> Progress:
    """Progress from a state document: streams by id, offsets by topic and partition."""
    state = spark.read.schema(STATE_JSON).option("multiLine", True).json(path)
    entries = state.select(F.explode("streams").alias("stream_id", "s"))
    streams = entries.select(
        "stream_id",
        "s.sync_mode",
        "s.last_lsn",
        parse_lsn(F.col("s.last_lsn")).alias("last_position"),
        "s.full_load_completed",
        "s.full_load_chunks_done",
        "s.full_load_chunks_total",
        "s.last_sync_time",
    )
    overall = state.filter(F.col("global_lsn").isNotNull()).select(
        F.lit(GLOBAL).alias("stream_id"),
        F.col("global_lsn").alias("last_lsn"),
        parse_lsn(F.col("global_lsn")).alias("last_position"),
    )
    offsets = (
        entries.select("stream_id", F.explode("s.kafka_offsets").alias("topic", "p"))
        .select("stream_id", "topic", F.explode("p").alias("partition", "last_offset"))
        .withColumn("partition", F.col("partition").cast("int"))
    )
    return Progress(streams.unionByName(overall, allowMissingColumns=True), offsets)
