"""What a user states about streams and destinations."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from changelake.functions.types import Field
from changelake.operators.catalog import FULL_LOAD_CDC
from changelake.session import small_frame
from changelake.sinks import parquet, tables

# Namespace and checkpoint settings used where none are given.
TABLE_NAMESPACE = "cdc_db"
CHECKPOINT_RECORDS = 10_000
CHECKPOINT_INTERVAL_MS = 5_000

CATALOG_SCHEMA = (
    "table string, source_topic string, sync_mode string, normalize_payload boolean, "
    "cursor_field string, primary_key array<string>, destination_table string"
)


@dataclass(frozen=True)
class Stream:
    """One entry of the catalog."""

    table: str
    source_topic: str | None = None
    sync_mode: str = FULL_LOAD_CDC
    normalize_payload: bool = False
    payload_columns: tuple[Field, ...] = ()
    cursor_field: str | None = None
    primary_key: tuple[str, ...] = ()
    destination_table: str | None = None

    @property
    def destination(self) -> str:
        return self.destination_table or self.table.partition(".")[2] or self.table


def catalog_frame(spark: SparkSession, streams: list[Stream]) -> DataFrame:
    """The catalog as a DataFrame, one row per stream."""
    names = [s.table for s in streams]
    if len(set(names)) != len(names):
        raise ValueError("a table is named twice in the catalog")
    rows = [
        (
            s.table, s.source_topic, s.sync_mode, s.normalize_payload, s.cursor_field,
            list(s.primary_key), s.destination_table,
        )
        for s in streams
    ]
    return small_frame(spark, rows, CATALOG_SCHEMA)


@dataclass(frozen=True)
class Destination:
    """Where change logs go: dated Parquet folders, or tables of a catalog."""

    type: str = "parquet"
    base_path: str = "/data/output"
    file_size_mb: int = parquet.FILE_SIZE_MB
    compression: str = parquet.COMPRESSION
    row_group_size_mb: int = parquet.ROW_GROUP_SIZE_MB
    table_namespace: str = TABLE_NAMESPACE
    table_format: str = "parquet"
    max_records: int | None = field(default=None)

    def write_batch(
        self, df: DataFrame, table: str, batch_id: str, ingest_date: datetime.date
    ) -> None:
        """Write a batch so that writing it again replaces it."""
        if self.type == "parquet":
            parquet.write_batch(
                df, self.base_path, table, batch_id, ingest_date, self.compression,
                self.row_group_size_mb, self.file_size_mb, self.max_records,
            )
        else:
            fmt = "iceberg" if self.type == "iceberg" else self.table_format
            tables.replace_batch(df, f"{self.table_namespace}.{table}", batch_id, fmt)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if self.type == "parquet":
            return spark.read.parquet(f"{self.base_path}/{table}")
        return spark.table(f"{self.table_namespace}.{table}")
