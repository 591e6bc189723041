"""Which micro-batches are whole, what they hold and how long they took.

The results of a batch lie in several folders, written side by side. A manifest of the
batch, one row per result, is written after all of them, as a single file that appears
at once; readers take the batches that have one. A batch that runs again after its
manifest is there is left as it is, so what has been shown never changes. Where another
query (a new checkpoint) writes to the same folder, its first step on a batch is to take
the old manifest away, and readers keep to the batches of the query that wrote last.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.streaming import sinks
from tallystream.workspace import table_or_empty

ENTRY = "query string, metric string, rows bigint, batch_time timestamp, started timestamp, ended timestamp"
COLUMNS = ("batch_id", "query", "metric", "rows", "batch_time", "started", "ended")

# Spark's name of the id that a query keeps over restarts.
QUERY_ID = "sql.streaming.queryId"


def manifest_path(out: str, topic: str, job: str, fmt: str) -> str:
    return f"{out.rstrip('/')}/{topic}/commits/{job}-{fmt}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return table_or_empty(spark, path, spark.read.schema(schema).parquet, schema)


def _entry(spark: SparkSession, place: str, batch_id: int, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{place}/batch_id={batch_id}")


def is_whole(spark: SparkSession, place: str, batch_id: int, query: str) -> bool:
    """Whether this query has written the batch before. The manifest of another query goes."""
    holder = _read(spark, f"{place}/batch_id={batch_id}", ENTRY).select("query").first()
    if holder is None:
        return False
    if holder["query"] == query:
        return True
    _entry(spark, place, batch_id, [])
    return False


def commit(
    spark: SparkSession, place: str, batch_id: int, query: str, rows: dict[str, int],
    batch_time: datetime | None, started: datetime, ended: datetime,
) -> None:
    """Makes a batch visible; ``rows`` has the number of rows of every result."""
    _entry(spark, place, batch_id, [(query, m, n, batch_time, started, ended) for m, n in rows.items()])


def manifest(spark: SparkSession, out: str, topic: str, fmt: str = "parquet", job: str = "metrics") -> DataFrame:
    """``batch_id, query, metric, rows, batch_time, started, ended`` of the whole batches of
    the query that wrote last."""
    entries = _read(spark, manifest_path(out, topic, job, fmt), f"batch_id bigint, {ENTRY}").select(*COLUMNS)
    latest = entries.agg(F.max_by("query", "ended").alias("query"))
    return entries.join(latest, "query", "left_semi")


def results(
    spark: SparkSession, out: str, topic: str, metric: str, fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """The rows of a result, of whole batches only. ``schema`` is needed for formats that carry none.

    The manifest is listed first: every file of a batch that it has is there by then.
    """
    whole = manifest(spark, out, topic, fmt).where(F.col("metric") == metric).select("batch_id")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**sinks.CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(sinks.result_path(out, topic, metric, fmt))
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return rows.join(whole, "batch_id", "left_semi")


def progress(
    spark: SparkSession, out: str, topic: str, fmt: str = "parquet", raw: str = "raw_data"
) -> DataFrame:
    """``batch_id, started, input_rows, millis`` of every batch of the metrics job, from the first on."""
    took = F.unix_millis("ended") - F.unix_millis("started")
    entries = manifest(spark, out, topic, fmt).where(F.col("metric") == raw)
    return entries.select("batch_id", "started", F.col("rows").alias("input_rows"), took.alias("millis"))


def covered(batches: Sequence[int], levels: Sequence[set[int]], fan: int) -> list[tuple[int, int]]:
    """``(level, last)`` of the fewest runs that hold the given batches.

    ``levels[k]`` has the last batch of every run of ``fan ** (k + 1)`` batches.
    """
    left, out = set(batches), []
    for level in range(len(levels), 0, -1):
        size = fan**level
        for last in sorted(levels[level - 1]):
            span = range(last - size + 1, last + 1)
            if left.issuperset(span):
                out.append((level, last))
                left.difference_update(span)
    return out + [(0, b) for b in sorted(left)]
