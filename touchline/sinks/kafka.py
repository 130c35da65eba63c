"""Matches as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import message_key


def to_messages(rows: DataFrame) -> DataFrame:
    """key and value per row: `season:match_id`, and a JSON object with every column as text.

    A row without an id takes its MatchID, and failing that a number that is unique within the job.
    """
    fallbacks = [F.col("MatchID")] if "MatchID" in rows.columns else []
    fallbacks.append(F.monotonically_increasing_id())
    identity = F.col("match_id") if "match_id" in rows.columns else F.lit(None)
    body = F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    value = F.to_json(body, {"ignoreNullFields": "false"})
    # String casts of all parts keep coalesce to one type.
    key = message_key(F.col("season"), identity.cast("string"), *[f.cast("string") for f in fallbacks])
    return rows.select(key.alias("key"), value.alias("value"))


def producer_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.linger.ms": "10",
        "kafka.batch.size": "16384",
    }


def publish(rows: DataFrame, servers: str, topic: str) -> None:
    to_messages(rows).write.format("kafka").options(**producer_options(servers, topic)).save()
