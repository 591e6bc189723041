"""Kafka topics as streaming tables. Needs Spark's Kafka package at launch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    broker: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    max_per_task: int | None = 1_000_000,
) -> dict[str, str]:
    """``starting`` counts at the first start only; later the checkpoint decides.

    ``max_offsets`` bounds a micro-batch, so that a backlog does not land in the
    first window whole. ``min_partitions`` splits topic partitions further when
    the topic has fewer of them than the job has cores, and ``max_per_task``
    splits a topic partition that holds most of the messages.
    """
    if not broker or not topic:
        raise ValueError("broker and topic are required")
    options = {"kafka.bootstrap.servers": broker, "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_per_task is not None:
        options["maxRecordsPerPartition"] = str(max_per_task)
    return options


def write_options(broker: str, topic: str) -> dict[str, str]:
    if not broker or not topic:
        raise ValueError("broker and topic are required")
    return {"kafka.bootstrap.servers": broker, "topic": topic}


def kafka_stream(spark: SparkSession, broker: str, topic: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**read_options(broker, topic, **options)).load()
