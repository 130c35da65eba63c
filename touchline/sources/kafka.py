"""Kafka topics: thin option wrappers around Spark's connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


MAX_PER_TRIGGER = 1000


def stream_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = MAX_PER_TRIGGER,
    fail_on_data_loss: bool = True,
):
    """Connector options. Batches are bounded unless max_per_trigger is None; offsets that the broker has already
    dropped are an error unless fail_on_data_loss is False, which skips them silently."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """An endless stream of (key, value, timestamp, ...)."""
    return spark.readStream.format("kafka").options(**stream_options(servers, topic, **options)).load()
