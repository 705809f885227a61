"""Topic messages to a typed change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from changelake.functions.types import Field
from changelake.operators.catalog import CDC
from changelake.operators.records import (
    add_cdc_metadata,
    enforce_required,
    event_time,
    normalize_payload,
)
from changelake.plans.config import Stream
from changelake.sources.topics import topic_envelope


def only_stream(streams: list[Stream]) -> Stream:
    """The one stream a topic source may have."""
    if len(streams) != 1:
        raise ValueError("a topic source takes exactly one stream")
    stream = streams[0]
    if not (stream.source_topic or "").strip():
        raise ValueError("a topic stream needs source_topic")
    if (stream.sync_mode or "").lower() != CDC:
        raise ValueError("a topic stream needs sync_mode cdc")
    return stream


def topic_log(messages: DataFrame, fields: list[Field], ingest_ts: Column, seen: Observation | None = None) -> DataFrame:
    """Envelope, payload columns, operation and time, and the reject reason.

    One projection over the messages, for batches and streams alike: every message is an INSERT
    at its own time. `seen` gets the counts of malformed values.
    """
    rows = normalize_payload(topic_envelope(messages), fields, seen)
    time = event_time(F.col("_kafka_timestamp_ms"), ingest_ts)
    return enforce_required(add_cdc_metadata(rows, F.lit("INSERT"), time), fields)
