"""Publishing to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish_frame(records: DataFrame, topic: str) -> DataFrame:
    """Records as the topic sink takes them."""
    return records.select(
        F.lit(topic).alias("topic"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def publish_topic(records: DataFrame, servers: str, topic: str) -> None:
    """Write key and value to a topic, acknowledged by all replicas. Needs the Kafka package."""
    (
        publish_frame(records, topic)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .save()
    )
