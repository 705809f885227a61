"""What there is to capture, and what to do with it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.functions.types import resolve_type

# Topics that belong to the message broker itself.
INTERNAL_TOPICS = ["__consumer_offsets", "__transaction_state"]

# Name prefixes of system tables.
SYSTEM_PREFIXES = ["pg_", "sql_"]

# Sync modes as they are written in a catalog.
FULL_LOAD = "full_load"
CDC = "cdc"
FULL_LOAD_CDC = "full_load+cdc"


def discover(
    columns: DataFrame, constraints: DataFrame, key_usage: DataFrame, schemas: Iterable[str]
) -> DataFrame:
    """One row per column of every user table in `schemas`.

    The inputs have the layout of the information schema: `columns`, `table_constraints` and
    `key_column_usage`.
    """
    wanted = F.col("table_schema").isin(list(schemas))
    keys = (
        constraints.filter((F.col("constraint_type") == "PRIMARY KEY") & wanted)
        .select("constraint_name", "table_schema", "table_name")
        .join(
            key_usage.select("constraint_name", "table_schema", "column_name"),
            ["constraint_name", "table_schema"],
        )
        .select("table_schema", "table_name", "column_name")
        .distinct()
        .withColumn("primary_key", F.lit(True))
    )
    system = F.lit(False)
    for prefix in SYSTEM_PREFIXES:
        system = system | F.col("table_name").startswith(prefix)
    by_udt = F.col("data_type").isin("USER-DEFINED", "ARRAY")
    return (
        columns.filter(wanted & ~system)
        .join(keys, ["table_schema", "table_name", "column_name"], "left")
        .select(
            F.concat_ws(".", "table_schema", "table_name").alias("table_name"),
            "column_name",
            resolve_type(F.when(by_udt, F.col("udt_name")).otherwise(F.col("data_type"))).alias(
                "type"
            ),
            F.coalesce(F.col("is_nullable") == "YES", F.lit(False)).alias("nullable"),
            F.coalesce("primary_key", F.lit(False)).alias("primary_key"),
            "ordinal_position",
        )
    )


def discover_topics(messages: DataFrame, topics: Iterable[str] = ()) -> DataFrame:
    """Topics seen in landed messages, without internal ones, with their stream ids."""
    listed = list(topics)
    found = messages.filter(~F.col("topic").isin(INTERNAL_TOPICS))
    if listed:
        found = found.filter(F.col("topic").isin(listed))
    table = F.concat(F.lit("kafka_"), F.replace(F.col("topic"), F.lit("."), F.lit("_")))
    return found.select("topic").distinct().select(
        "topic", F.concat_ws(".", "topic", table).alias("stream_id")
    )


def stream_select(discovered: DataFrame, catalog: DataFrame) -> DataFrame:
    """Discovered tables that the catalog names."""
    names = catalog.select(F.col("table").alias("table_name")).distinct()
    return discovered.join(names, "table_name", "left_semi")


def sync_plan(catalog: DataFrame, progress: DataFrame) -> DataFrame:
    """What each stream of the catalog needs, given its progress."""
    text = F.lower(F.coalesce("sync_mode", F.lit(FULL_LOAD_CDC)))
    mode = F.when(text.isin(FULL_LOAD, CDC), text).otherwise(FULL_LOAD_CDC)
    own = F.when(F.col("destination_table") != "", F.col("destination_table"))
    short = F.when(
        F.contains("table", F.lit(".")), F.expr("substring(`table`, instr(`table`, '.') + 1)")
    ).otherwise(F.col("table"))
    done = progress.select(F.col("stream_id").alias("table"), "full_load_completed")
    return (
        catalog.select("table", mode.alias("mode"), F.coalesce(own, short).alias("destination"))
        .join(done, "table", "left")
        .select(
            "table",
            "mode",
            (
                F.col("mode").isin(FULL_LOAD, FULL_LOAD_CDC)
                & ~F.coalesce("full_load_completed", F.lit(False))
            ).alias("needs_full_load"),
            F.col("mode").isin(CDC, FULL_LOAD_CDC).alias("needs_cdc"),
            "destination",
        )
    )
