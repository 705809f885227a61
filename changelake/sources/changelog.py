"""Landed change messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changelake.operators.changes import MESSAGE_SCHEMA


def change_log_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = 1000
) -> DataFrame:
    """Unbounded read of message files in order of arrival; resumed from the checkpoint.

    Files may land in any order; `files_per_trigger` only sets how much a batch takes.
    """
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def change_log(spark: SparkSession, path: str) -> DataFrame:
    """The same messages as a bounded table."""
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)
