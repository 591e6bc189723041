"""Distinct users of windows wider than a micro-batch.

Counts of distinct users cannot be added up, sets can be merged. Every batch leaves a
run: its distinct (window, e-mail) with the number of messages and the first batch.
Eight runs are merged into one of the next level, eight of those into one above, and so
on, so every row is rewritten once for each level and a reader merges a few runs for
each level, however many batches there were. A merged run counts once its manifest is
written; until then the smaller ones do. Runs that a larger one replaced are no longer
read and can be removed.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.operators.windows import assign_window
from tallystream.streaming import commits

RUNS = "user_runs"
FAN = 8
RUN = "window_start timestamp, email string, first_batch bigint, n bigint"


def run_path(out: str, topic: str, seconds: int, level: int, last: int) -> str:
    return f"{out.rstrip('/')}/{topic}/{RUNS}/{seconds}s/level={level}/last={last}"


def run_of_batch(good: DataFrame, seconds: int, ts: str = "timestamp") -> DataFrame:
    """The users of a batch by window. NULL is no user, but its messages count."""
    rows = assign_window(good, ts, seconds).groupBy("window_start", "email")
    return rows.agg(F.min("batch_id").cast("bigint").alias("first_batch"), F.count("*").alias("n"))


def merged(runs: DataFrame) -> DataFrame:
    rows = runs.groupBy("window_start", "email")
    return rows.agg(F.min("first_batch").alias("first_batch"), F.sum("n").alias("n"))


def _level(seconds: int, level: int) -> str:
    return f"users-{seconds}s-{level}"


def merge_up(spark: SparkSession, out: str, topic: str, seconds: int, batch_id: int, query: str) -> None:
    """Writes the larger runs that end with this batch, unless they are there."""
    level = 1
    while (batch_id + 1) % FAN**level == 0:
        place = commits.manifest_path(out, topic, _level(seconds, level), "parquet")
        if not commits.is_whole(spark, place, batch_id, query):
            started = datetime.now(timezone.utc)
            step = FAN ** (level - 1)
            parts = [run_path(out, topic, seconds, level - 1, batch_id - k * step) for k in range(FAN)]
            path = run_path(out, topic, seconds, level, batch_id)
            merged(spark.read.schema(RUN).parquet(*parts)).write.mode("overwrite").parquet(path)
            rows = {RUNS: spark.read.schema(RUN).parquet(path).count()}
            commits.commit(spark, place, batch_id, query, rows, None, started, datetime.now(timezone.utc))
        level += 1


def current_runs(spark: SparkSession, out: str, topic: str, seconds: int, fmt: str = "parquet") -> list[tuple[int, int]]:
    """``(level, last)`` of the runs that hold all whole batches: some for each level."""
    base = commits.manifest(spark, out, topic, fmt).where(F.col("metric") == RUNS).select("batch_id", "query").collect()
    if not base:
        return []
    last = max(r["batch_id"] for r in base)
    levels = []
    while FAN ** (len(levels) + 1) <= last + 1:
        larger = commits.manifest(spark, out, topic, "parquet", _level(seconds, len(levels) + 1))
        levels.append({r["batch_id"] for r in larger.where(F.col("query") == base[0]["query"]).collect()})
    return commits.covered([r["batch_id"] for r in base], levels, FAN)


def all_users(spark: SparkSession, out: str, topic: str, seconds: int, fmt: str = "parquet") -> DataFrame:
    """``window_start, email, first_batch, n`` over all whole batches."""
    paths = [run_path(out, topic, seconds, *run) for run in current_runs(spark, out, topic, seconds, fmt)]
    rows = spark.read.schema(RUN).parquet(*paths) if paths else spark.createDataFrame([], RUN)
    return merged(rows)


def window_users(spark: SparkSession, out: str, topic: str, seconds: int, fmt: str = "parquet") -> DataFrame:
    """``window_start, unique_users, message_total`` over all whole batches."""
    rows = all_users(spark, out, topic, seconds, fmt).groupBy("window_start")
    return rows.agg(F.count("email").alias("unique_users"), F.sum("n").alias("message_total"))
