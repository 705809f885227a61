"""Message topics. The frame has the layout of Spark's topic source:

key, value, topic, partition int, offset bigint, timestamp
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a sample event holds.
SAMPLE_FIRST_USER = 1000
SAMPLE_EVENT_TYPE = "test"
SAMPLE_MESSAGE = "hello"


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    min_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
    max_delay_ms: int | None = None,
) -> DataFrame:
    """Subscribe to one topic, key and value as text. Needs Spark's Kafka package.

    A batch begins once so many messages wait, or after the delay, and takes all that wait.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**(options or {}))
    )
    if min_offsets_per_trigger:
        reader = reader.option("minOffsetsPerTrigger", min_offsets_per_trigger)
    if max_delay_ms:
        reader = reader.option("maxTriggerDelay", f"{max_delay_ms}ms")
    return text_messages(reader.load())


def text_messages(raw: DataFrame) -> DataFrame:
    """Key and value as text, other columns as the source gives them."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def topic_envelope(messages: DataFrame) -> DataFrame:
    """One envelope row per message."""
    return messages.select(
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.col("key").alias("_kafka_key"),
        F.unix_millis("timestamp").alias("_kafka_timestamp_ms"),
        F.col("value").alias("_payload"),
    )


def sample_events(numbers: DataFrame, created_at: Column) -> DataFrame:
    """Synthetic events, one per row of `numbers.i` (from 1), as key and JSON value."""
    user = F.col("i") + SAMPLE_FIRST_USER
    instant = F.date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    event = F.struct(
        user.alias("user_id"),
        F.lit(SAMPLE_EVENT_TYPE).alias("event_type"),
        instant.alias("created_at"),
        F.col("i").alias("seq"),
        F.lit(SAMPLE_MESSAGE).alias("message"),
    )
    return numbers.select(user.cast("string").alias("key"), F.to_json(event).alias("value"))


def sample_range(spark: SparkSession, count: int, created_at: Column) -> DataFrame:
    """`count` synthetic events."""
    return sample_events(spark.range(1, count + 1).withColumnRenamed("id", "i"), created_at)


def sample_stream(spark: SparkSession, per_second: int) -> DataFrame:
    """Synthetic events without end, at a steady rate."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return sample_events(
        rate.select((F.col("value") + 1).alias("i"), "timestamp"), F.col("timestamp")
    )
