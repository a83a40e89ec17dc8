"""Kafka topics as one-column text streams. Needs the Spark Kafka connector on the cluster."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_read_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str | dict[int, int] = "earliest",
    max_per_batch: int | None = None,
) -> dict[str, str]:
    """Options of a topic reader; ``starting`` is earliest, latest or {partition: offset}."""
    if isinstance(starting, dict):
        starting = json.dumps({topic: {str(p): o for p, o in starting.items()}})
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group is not None:
        options["kafka.group.id"] = group
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def text_values(raw: DataFrame, positions: bool = False) -> DataFrame:
    """The value column as text; tombstones (null values) are dropped.

    With ``positions`` the column ``arrival`` keeps the offset. Change topics are partitioned by row key,
    so the records of one key lie in one partition and their offsets are their order of arrival, which the
    newest-version rules then follow in batches and streams alike.
    """
    kept = [F.col("offset").cast("bigint").alias("arrival")] if positions else []
    return raw.select(F.col("value").cast("string").alias("value"), *kept).filter(F.col("value").isNotNull())


def kafka_stream(spark: SparkSession, servers: str, topic: str, positions: bool = False, **kw) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_read_options(servers, topic, **kw))
    return text_values(reader.load(), positions)


def kafka_batch(spark: SparkSession, servers: str, topic: str, positions: bool = False, **kw) -> DataFrame:
    reader = spark.read.format("kafka").options(**kafka_read_options(servers, topic, **kw))
    return text_values(reader.load(), positions)
