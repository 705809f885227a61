"""Settings from documents (parsed YAML or JSON): catalog, destination and source."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from changelake.functions.types import SPARK_TYPES, Field
from changelake.operators.catalog import FULL_LOAD_CDC
from changelake.plans.config import (
    CHECKPOINT_INTERVAL_MS,
    CHECKPOINT_RECORDS,
    TABLE_NAMESPACE,
    Destination,
    Stream,
)
from changelake.sinks import parquet
from changelake.sources.tables import JdbcTables

# Name under which the session knows the catalog of table destinations.
CATALOG = "changelake"

# Source settings used where a document names none.
HOST, PORT, SCHEMAS = "localhost", 5432, ["public"]
START = "latest"


def _field(column: dict[str, Any]) -> Field:
    kind = column.get("type") or "STRING"
    if kind not in SPARK_TYPES:
        raise ValueError(f"unknown column type {kind}")
    return Field(column.get("name") or "", kind, column.get("nullable", True))


def streams(catalog: dict[str, Any]) -> list[Stream]:
    """The streams of a catalog document; settings that are not known are passed over."""
    return [
        Stream(
            table=entry["table"],
            source_topic=entry.get("source_topic"),
            sync_mode=entry.get("sync_mode", FULL_LOAD_CDC),
            normalize_payload=entry.get("normalize_payload", False),
            payload_columns=tuple(_field(c) for c in entry.get("payload_columns") or () if c),
            cursor_field=entry.get("cursor_field"),
            primary_key=tuple(entry.get("primary_key") or ()),
            destination_table=entry.get("destination_table"),
        )
        for entry in catalog.get("streams") or ()
    ]


def destination(document: dict[str, Any]) -> Destination:
    """The destination of a document."""
    kind = document.get("type", "parquet").lower()
    namespace = document.get("table_namespace", TABLE_NAMESPACE)
    return Destination(
        type=kind,
        base_path=document.get("base_path", "/data/output"),
        file_size_mb=document.get("file_size_mb", parquet.FILE_SIZE_MB),
        compression=document.get("compression") or parquet.COMPRESSION,
        row_group_size_mb=document.get("row_group_size_mb", parquet.ROW_GROUP_SIZE_MB),
        table_namespace=f"{CATALOG}.{namespace}" if kind == "iceberg" else namespace,
    )


def catalog_settings(document: dict[str, Any]) -> dict[str, str]:
    """Session settings of the catalog that an Iceberg destination writes to."""
    kind = document.get("catalog_type", "hadoop").lower()
    if kind != "hadoop":
        raise ValueError(f"catalog type {kind} is not supported")
    warehouse = document.get("warehouse") or document.get("base_path", "/data/output")
    prefix = f"spark.sql.catalog.{CATALOG}"
    settings = {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "hadoop",
        f"{prefix}.warehouse": warehouse,
    }
    for name, value in (document.get("catalog_properties") or {}).items():
        settings[f"{prefix}.{name}"] = value
    return settings


def _consumer(document: dict[str, Any]) -> dict[str, str]:
    """Options of the topic's consumer."""
    options = {f"kafka.{k}": str(v) for k, v in (document.get("consumer_properties") or {}).items()}
    if document.get("group_id"):
        options["kafka.group.id"] = document["group_id"]
    return options


@dataclass(frozen=True)
class TopicSource:
    """How to reach a topic, and when to checkpoint."""

    servers: str
    start: str = START
    topics: tuple[str, ...] = ()
    records: int = CHECKPOINT_RECORDS
    interval_ms: int = CHECKPOINT_INTERVAL_MS
    partitions: int = 1
    options: dict[str, str] = field(default_factory=dict)


def source(document: dict[str, Any]) -> JdbcTables | TopicSource:
    """The source of a document: tables of a database, or a topic."""
    kind = (document.get("type") or "postgres").strip().lower()
    if kind == "kafka":
        servers = document.get("bootstrap_servers")
        if not (servers or "").strip():
            raise ValueError("a topic source needs bootstrap_servers")
        return TopicSource(
            servers,
            document.get("auto_offset_reset", START),
            tuple(document.get("topics") or ()),
            document.get("checkpoint_records", CHECKPOINT_RECORDS),
            document.get("checkpoint_interval_ms", CHECKPOINT_INTERVAL_MS),
            document.get("partitions", 1),
            _consumer(document),
        )
    if kind != "postgres":
        raise ValueError(f"source type {kind} is not supported")
    host, port = document.get("host", HOST), document.get("port", PORT)
    login = {k: document[v] for k, v in (("user", "username"), ("password", "password"))
             if document.get(v) is not None}
    return JdbcTables(
        f"jdbc:postgresql://{host}:{port}/{document.get('database')}",
        login,
        tuple(document.get("schemas") or SCHEMAS),
    )
