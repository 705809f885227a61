"""Shaping records: projection, metadata, required columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from changelake.functions.casts import cast_text
from changelake.functions.payload import parse_payload, typed_fields
from changelake.functions.types import (
    OPERATION_COLUMN,
    SPARK_TYPES,
    TIMESTAMP_COLUMN,
    Field,
    payload_fields,
)


def project_to_schema(df: DataFrame, fields: Iterable[Field], keep: Iterable[str] = ()) -> DataFrame:
    """The schema's columns in order: missing ones become null, extra ones are dropped."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f"`{f.name}`") if f.name in have
            else F.lit(None).cast(SPARK_TYPES[f.type]).alias(f.name)
            for f in fields
        ],
        *[F.col(f"`{name}`") for name in keep],
    )


def project_image(image: Column, fields: Iterable[Field]) -> list[Column]:
    """The schema's columns from a map of column name to text, cast to their types."""
    return [
        cast_text(F.try_element_at(image, F.lit(f.name)), f.type).alias(f.name) for f in fields
    ]


def count_malformed(df: DataFrame, texts: dict[str, Column], fields: Iterable[Field], seen: Observation) -> DataFrame:
    """The same rows; the job that reads them first counts by the way, for each field, the values that are null though there is a text."""
    typed = [f.name for f in fields if f.type not in ("STRING", "JSON", "UUID")]
    wrong = [F.count(F.when(texts[n].isNotNull() & F.col(f"`{n}`").isNull(), 1)).alias(n) for n in typed]
    return df.observe(seen, F.count(F.lit(1)).alias("_rows"), *wrong)


def normalize_payload(df: DataFrame, fields: Iterable[Field], seen: Observation | None = None) -> DataFrame:
    """Add the declared payload columns; `_payload` stays as raw text. `seen` gets the counts of malformed values."""
    declared = payload_fields(fields)
    if not declared:
        return df
    parsed = df.withColumn("_parsed", parse_payload(F.col("_payload"), declared))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in {f.name for f in declared}]
    typed = parsed.select(*kept, *typed_fields(F.col("_parsed"), declared), *(["_parsed"] if seen is not None else []))
    if seen is None:
        return typed
    return count_malformed(typed, {f.name: F.col("_parsed").getField(f.name) for f in declared}, declared, seen).drop("_parsed")


def event_time(timestamp_ms: Column, ingest_ts: Column) -> Column:
    """The message's own time if it has one, else the time of ingestion."""
    return F.when(timestamp_ms > 0, F.timestamp_millis(timestamp_ms)).otherwise(ingest_ts)


def add_cdc_metadata(df: DataFrame, operation: Column, timestamp: Column) -> DataFrame:
    """Tag every row with its operation and time."""
    return df.withColumns({OPERATION_COLUMN: operation, TIMESTAMP_COLUMN: timestamp})


def change_operation() -> Column:
    """Operation name of a row change."""
    return (
        F.when(F.col("msg_type") == "I", "INSERT")
        .when(F.col("msg_type") == "U", "UPDATE")
        .when(F.col("msg_type") == "D", "DELETE")
        .when(F.col("msg_type") == "T", "TRUNCATE")
    )


def enforce_required(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """Add `_reject_reason`: the required columns that are null, or null for a good row."""
    missing = [
        F.when(F.col(f"`{f.name}`").isNull(), f.name) for f in fields if not f.nullable
    ]
    reason = F.concat_ws(",", *missing) if missing else F.lit("")
    return df.withColumn("_reject_reason", F.nullif(reason, F.lit("")))


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason column, and the rejected rows with it."""
    good = checked.filter(F.col("_reject_reason").isNull()).drop("_reject_reason")
    return good, checked.filter(F.col("_reject_reason").isNotNull())


def fail_on_rejects(checked: DataFrame) -> DataFrame:
    """Fail the job at the first row that lacks a required column."""
    message = F.concat(F.lit("null in required column: "), F.col("_reject_reason"))
    guard = F.when(F.col("_reject_reason").isNotNull(), F.raise_error(message).cast("boolean"))
    return checked.filter(F.coalesce(guard, F.lit(True))).drop("_reject_reason")
