"""Replay at the pace of a clock: message i leaves i * seconds after the first.

The pace does not hang on files or batches. Records are numbered once and kept in the
order of their numbers; a clock ticks as a stream, and every batch of ticks lets those
messages go that have become due. A batch that runs again has the same ticks and lets
the same messages go.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystream.operators.ordering import with_ordinal
from tallystream.streaming import sinks
from tallystream.workspace import stored

ORDINAL = "ordinal"

Release = Callable[[DataFrame, int], None]


def numbered(records: DataFrame, *order_by: str | Column) -> DataFrame:
    """The records as a table sorted by number, so that a batch reads only the files it needs."""
    spark = records.sparkSession
    return stored(spark, with_ordinal(records, *order_by, name=ORDINAL), "replay")


def due(first_tick: int, last_tick: int, ticks_per_second: int, seconds: Decimal) -> tuple[int, int]:
    """The numbers ``from`` (included) ``to`` (excluded) that become due within some ticks."""
    step = Decimal(ticks_per_second) * seconds  # ticks from one message to the next
    return math.ceil(Decimal(first_tick) / step), math.ceil(Decimal(last_tick + 1) / step)


def start(
    records: DataFrame, release: Release, seconds: float, checkpoint: str, *, ticks_per_second: int | None = None,
    trigger: str = "1 second", name: str = "replay",
) -> StreamingQuery:
    """Runs until it is stopped or all ``records`` (of ``numbered``) have left; the last batch may
    run empty ticks. ``release`` takes the messages that are due and the number of the batch."""
    pace = Decimal(str(seconds))
    if pace <= 0:
        raise ValueError("seconds between messages must be positive; without a pace, send them")
    ticks = ticks_per_second or max(1, math.ceil(1 / pace))
    total = records.count()

    def write(clock: DataFrame, batch_id: int) -> None:
        seen = clock.agg(F.min("value"), F.max("value")).first()
        if seen[0] is None:
            return
        low, high = due(seen[0], seen[1], ticks, pace)
        if low < total:
            release(records.where(F.col(ORDINAL).between(low, high - 1)), batch_id)
        if high >= total:
            finished.set()

    finished = threading.Event()
    spark = records.sparkSession
    clock = spark.readStream.format("rate").option("rowsPerSecond", ticks).load()
    query = (
        clock.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger).queryName(name).start()
    )
    _ENDS[query.runId] = finished
    return query


# When the last message of a running replay has left.
_ENDS: dict[str, threading.Event] = {}


def finish(query: StreamingQuery) -> None:
    """Waits until all messages have left, then stops the clock. A failure is raised."""
    ended = _ENDS.pop(query.runId)
    while query.isActive and not ended.wait(0.2):
        pass
    if ended.is_set():
        query.stop()
    query.awaitTermination()


def to_topic(broker: str, topic: str) -> Release:
    """Releases messages into a topic."""
    return lambda messages, batch_id: sinks.publish(messages, broker, topic)


def to_folder(out: str) -> Release:
    """Releases messages as JSON lines, one folder per batch, with the time they left."""

    def release(messages: DataFrame, batch_id: int) -> None:
        rows = messages.withColumn("left_at", F.current_timestamp())
        rows.write.mode("overwrite").json(f"{out}/batch_id={batch_id}")

    return release
