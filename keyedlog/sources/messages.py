"""Streams of keyed messages: columns ``key`` and ``value``, both binary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = "key binary, value binary"


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """One Kafka topic, committed messages only. Needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.isolation.level", "read_committed")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )


def read_message_files(
    spark: SparkSession, path: str, format: str = "parquet", **options: str
) -> DataFrame:
    """Messages arriving as files in a folder, for example ``maxFilesPerTrigger='10'``."""
    reader = spark.readStream.format(format).schema(MESSAGE_SCHEMA)
    return reader.options(**options).load(path)
