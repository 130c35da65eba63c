"""Message stream -> matches table: the same parse step for batch and stream, and a replay-safe sink.

foreachBatch delivers at least once. The sink merges by key and by the place of the message, which is stored with its
row, so the table depends neither on the borders of batches nor on their order, and a replayed batch, or a whole replay
under a new checkpoint, leaves it as it is.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline import fixed, schema
from touchline.functions.text import blank_to_null, lenient_int
from touchline.sinks.merge import merge_table, message_order

_NUMBERS = ("home_goals", "away_goals")


_PLACE = ("timestamp", "partition", "offset")
_BROKEN = "_corrupt_record"


def judge_messages(envelope: DataFrame, payload: T.StructType = schema.MESSAGE_PAYLOAD) -> DataFrame:
    """(value, timestamp) -> typed rows with value, kafka_timestamp and `reason`: why a message is turned away, else NULL.

    An envelope with a partition and an offset passes them on as kafka_partition and kafka_offset.

    Payload values arrive as text: numbers are cast leniently, blanks become NULL. The parsed object goes through a
    generator, which filters are not pushed into: otherwise the JSON would be parsed again for the key filter.
    """
    wanted = T.StructType([*payload.fields, T.StructField(_BROKEN, T.StringType())])
    body = F.from_json(F.col("value").cast("string"), wanted, {"columnNameOfCorruptRecord": _BROKEN})
    nothing = F.lit(None).cast(wanted)
    place = [F.col(c).alias(f"kafka_{c}") for c in _PLACE if c in envelope.columns]
    # An empty value has no object at all.
    parsed = envelope.select(F.inline(F.array(F.coalesce(body, nothing))), "value", body.isNull().alias("_absent"), *place)
    columns = [
        (lenient_int(F.col(f.name)) if f.name in _NUMBERS else blank_to_null(F.col(f.name))).alias(f.name)
        for f in payload.fields
    ]
    broken = F.col("_absent") | F.col(_BROKEN).isNotNull()
    reason = F.when(broken, fixed.MALFORMED).when(blank_to_null(F.col("match_id")).isNull(), fixed.WITHOUT_KEY).alias("reason")
    return parsed.select(*columns, *[c for c in parsed.columns if c.startswith("kafka_")], "value", reason)


def parse_messages(envelope: DataFrame, payload: T.StructType = schema.MESSAGE_PAYLOAD) -> DataFrame:
    """The typed rows of judge_messages alone; messages without a key or valid JSON are dropped."""
    return judge_messages(envelope, payload).filter("reason IS NULL").drop("value", "reason")


def _stored_form(rows: DataFrame, layout: T.StructType) -> DataFrame:
    """Places that the source does not tell are NULL."""
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in layout.fields if f.name not in rows.columns})


def batch_sink(
    path: str,
    layout: T.StructType = schema.STREAM_TABLE,
    mode: str = "insert_only",
    on_batch: Callable[[int, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch handler that merges each batch of parsed messages by match_id; an empty batch writes nothing.

    Of a key's messages `insert_only` keeps the first and `upsert` the last, by timestamp, partition and offset, whether they
    come in one batch or in several, in this or another order.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        order = [c for c in message_order(batch.columns) if c in layout.names]
        written = merge_table(
            _stored_form(batch, layout), path, layout, ["match_id"], mode=mode, order_by=order, oldest=mode == "insert_only", guard=order,
        )
        if on_batch:
            on_batch(batch_id, written)

    return handle


@dataclass
class Drained:
    """What became of the messages, and why the drain ended: at its `target` or at the `deadline`."""
    read: int = 0
    malformed: int = 0
    without_key: int = 0
    merged: int = 0
    batches: int = 0
    ended: str = ""


def message_sink(
    path: str, mode: str = "insert_only", rejects: str | None = None, counts: Drained | None = None,
    on_batch: Callable[[int, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch handler for unparsed messages: good ones are merged as by batch_sink, counts are observed on the way.

    With `rejects`, the others go to that table with their reason and place, from the same single parse; a replayed batch
    adds none again. Messages whose source tells no partition and offset are told apart by time and value.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        turned_away = [F.count_if(F.col("reason") == r).alias(r) for r in (fixed.MALFORMED, fixed.WITHOUT_KEY)]
        judged = judge_messages(batch).observe(seen, F.count(F.lit(1)).alias("read"), *turned_away)
        if rejects:  # read twice; the merge alone keeps what it needs of the rows
            judged = judged.persist()
        try:
            written: list[int] = []
            batch_sink(path, mode=mode, on_batch=lambda _, rows: written.append(rows))(judged.filter("reason IS NULL"), batch_id)
            if rejects:
                _reject(judged.filter("reason IS NOT NULL"), rejects)
            if counts is not None:
                got = seen.get
                counts.read += got["read"]
                counts.malformed += got[fixed.MALFORMED]
                counts.without_key += got[fixed.WITHOUT_KEY]
                counts.merged += written[0]
                counts.batches += 1
            if on_batch:
                on_batch(batch_id, written[0])
        finally:
            if rejects:
                judged.unpersist()

    return handle


def _reject(rows: DataFrame, path: str) -> None:
    rows = _stored_form(rows, schema.REJECTED)
    known = F.concat_ws(":", "kafka_partition", "kafka_offset")
    unknown = F.concat_ws(":", F.col("kafka_timestamp").cast("string"), F.sha2(F.coalesce("value", F.lit(b"")), 256))
    place = F.when(F.col("kafka_offset").isNotNull(), known).otherwise(unknown)
    merge_table(rows.withColumn("place", place), path, schema.REJECTED, ["place"], mode="insert_only", partition_by=None)


def start_ingest(
    envelope: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    interval: str = fixed.TRIGGER_INTERVAL,
    mode: str = "insert_only",
    on_batch: Callable[[int, int], None] | None = None,
    rejects: str | None = None,
    handler: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start ingesting; `once` drains what is available and stops, in batches as large as the source's own limit."""
    handler = handler or message_sink(path, mode, rejects, on_batch=on_batch)
    writer = envelope.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def drain_until(
    envelope: DataFrame, path: str, checkpoint: str, mode: str = "insert_only", deadline_sec: float | None = fixed.DRAIN_SECONDS,
    rejects: str | None = None,
) -> Drained:
    """Process what is there at the start, up to the deadline.

    The source fixes its end when the query starts: what arrives later waits for the next drain. At the deadline the
    batch in work is finished and no other begins; the checkpoint knows where to go on.
    """
    counts, turn = Drained(), threading.Lock()
    sink, over = message_sink(path, mode, rejects, counts), False

    def handle(batch: DataFrame, batch_id: int) -> None:
        with turn:
            if over:  # must not return, or the batch would count as done
                raise TimeoutError("the drain's deadline has passed")
            sink(batch, batch_id)

    end = None if deadline_sec is None else time.monotonic() + deadline_sec
    query = start_ingest(envelope, path, checkpoint, once=True, handler=handle)
    try:
        finished = query.awaitTermination() if end is None else query.awaitTermination(max(0.001, end - time.monotonic()))
        if finished is False:
            with turn:  # waits for the batch in work
                over = query.isActive
    except StreamingQueryException:
        query.stop()
        raise
    if over:
        query.stop()
    counts.ended = "deadline" if over else "target"
    return counts


def drain(envelope: DataFrame, path: str, checkpoint: str, mode: str = "insert_only") -> int:
    """Process everything available now and wait for it, however long; returns the number of rows merged in."""
    return drain_until(envelope, path, checkpoint, mode, deadline_sec=None).merged
