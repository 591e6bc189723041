"""A table of every micro-batch of a query, kept from the first to the last.

Spark itself remembers the latest updates only and forgets them with the driver. A
listener writes one row per batch, in a folder of its own per batch, so a batch that is
reported again replaces its row. A driver that dies between a batch's end and its report
leaves a gap; it is filled at the next start from the query's own log, with the time of
the batch and unknown rows and duration.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tallystream.workspace import table_or_empty

ROW = "query string, started timestamp, input_rows bigint, millis bigint"
COLUMNS = ("batch_id", "started", "input_rows", "millis")


def progress_path(out: str, topic: str, job: str, fmt: str) -> str:
    return f"{out.rstrip('/')}/{topic}/progress/{job}-{fmt}"


class ProgressLog(StreamingQueryListener):
    """Writes the batches of the query of one name below ``place``."""

    def __init__(self, spark: SparkSession, place: str, name: str):
        self.spark, self.place, self.name = spark, place, name
        self.run = None
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name and self.run is None:
            self.run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        # A trigger without a batch is reported too, under the number of the next batch.
        if str(p.runId) != self.run or "addBatch" not in p.durationMs:
            return
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        row = (str(p.id), started, p.numInputRows, p.durationMs.get("triggerExecution"))
        rows = self.spark.createDataFrame([row], ROW).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.place}/batch_id={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            self.ended.set()

    def settle(self, seconds: float) -> None:
        """Waits for the rows of the last batches of a query that has ended."""
        self.ended.wait(seconds)
        self.spark.streams.removeListener(self)


def fill_gaps(spark: SparkSession, place: str, checkpoint: str) -> None:
    """Rows for batches that the query has finished but never reported."""
    name = F.col("_metadata.file_name").cast("bigint").alias("batch_id")
    text = lambda part: table_or_empty(
        spark, f"{checkpoint}/{part}", lambda p: spark.read.text(p, wholetext=True).select(name, "value"), "batch_id bigint, value string"
    )
    known = rows(spark, place).select("batch_id")
    done = text("commits").select("batch_id").join(known, "batch_id", "left_anti")
    # Line 2 of the log of a batch has its time.
    meta = F.get_json_object(F.split("value", "\n")[1], "$.batchTimestampMs").cast("bigint")
    missing = done.join(text("offsets").select("batch_id", F.timestamp_millis(meta).alias("started")), "batch_id", "left")
    # As many as the batches since the last report, at most the log that Spark keeps.
    for row in missing.collect():
        entry = spark.createDataFrame([(None, row["started"], None, None)], ROW)
        entry.write.mode("overwrite").parquet(f"{place}/batch_id={row['batch_id']}")


def rows(spark: SparkSession, place: str) -> DataFrame:
    """``batch_id, started, input_rows, millis`` of every batch."""
    schema = f"batch_id bigint, {ROW}"
    table = table_or_empty(spark, place, lambda p: spark.read.schema(schema).parquet(p), schema)
    return table.select(*COLUMNS)


def batches(spark: SparkSession, out: str, topic: str, job: str, fmt: str = "parquet") -> DataFrame:
    """The batches of a job by the names it was started with."""
    return rows(spark, progress_path(out, topic, job, fmt))
