"""Few files for many batches: results of batches merged into runs while readers read.

Every batch leaves a folder per result. Eight of them (``FAN``) become one run, eight
runs one of the next level, and so on, so a row is rewritten once for each level. A run
counts from the moment its manifest is there, which is one file; readers choose the
fewest runs that hold all whole batches. What a run replaces stays where it is, so a
reader that chose before is not disturbed; ``replaced`` names the folders that can go
once no reader is left that began earlier.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.streaming import commits, sinks

FAN = 8
FILE_ROWS = 1_000_000  # about, of a file of a run


def run_path(out: str, topic: str, metric: str, fmt: str, level: int, last: int) -> str:
    if level == 0:
        return f"{sinks.result_path(out, topic, metric, fmt)}/batch_id={last}"
    return f"{out.rstrip('/')}/{topic}/runs/{metric}/{fmt}/level={level}/last={last}"


def _job(metric: str, level: int) -> str:
    return f"{metric}-runs-{level}"


def _union(spark: SparkSession, out: str, topic: str, metric: str, runs: list[tuple[int, int]], schema: T.StructType) -> DataFrame:
    """One scan for all runs of a level, so the plan does not grow with their number."""
    rows = spark.createDataFrame([], schema)
    upper = [run_path(out, topic, metric, "parquet", *run) for run in runs if run[0]]
    if upper:
        rows = rows.unionByName(spark.read.schema(schema).parquet(*upper))
    single = [run_path(out, topic, metric, "parquet", *run) for run in runs if not run[0]]
    if single:
        base = sinks.result_path(out, topic, metric)
        reader = spark.read.option("basePath", base).schema(schema)
        rows = rows.unionByName(reader.parquet(*single).select(*schema.names))
    return rows


def _schema(spark: SparkSession, out: str, topic: str, metric: str, run: tuple[int, int]) -> T.StructType:
    fields = spark.read.parquet(run_path(out, topic, metric, "parquet", *run)).schema.fields
    return T.StructType([T.StructField("batch_id", T.LongType()), *(f for f in fields if f.name != "batch_id")])


def current_runs(spark: SparkSession, out: str, topic: str, metric: str) -> list[tuple[int, int]]:
    """``(level, last)`` of the fewest runs that hold all whole batches."""
    base = commits.manifest(spark, out, topic).where(F.col("metric") == metric).select("batch_id", "query").collect()
    if not base:
        return []
    last = max(r["batch_id"] for r in base)
    levels = []
    while FAN ** (len(levels) + 1) <= last + 1:
        larger = commits.manifest(spark, out, topic, "parquet", _job(metric, len(levels) + 1))
        levels.append({r["batch_id"] for r in larger.where(F.col("query") == base[0]["query"]).collect()})
    return commits.covered([r["batch_id"] for r in base], levels, FAN)


def compact(spark: SparkSession, out: str, topic: str, metric: str) -> list[tuple[int, int]]:
    """Merges what can be merged and gives the new runs. Can be started again at any point;
    one compaction of a result at a time."""
    base = commits.manifest(spark, out, topic).where(F.col("metric") == metric).select("batch_id", "query", "rows").collect()
    made = []
    if not base:
        return made
    query, rows_of = base[0]["query"], {r["batch_id"]: r["rows"] for r in base}
    schema = _schema(spark, out, topic, metric, current_runs(spark, out, topic, metric)[0])
    level = 1
    while FAN**level <= max(rows_of) + 1:
        size, below = FAN**level, FAN ** (level - 1)
        for last in range(size - 1, max(rows_of) + 1, size):
            batches = range(last - size + 1, last + 1)
            place = commits.manifest_path(out, topic, _job(metric, level), "parquet")
            if not rows_of.keys() >= set(batches) or commits.is_whole(spark, place, last, query):
                continue
            started = datetime.now(timezone.utc)
            parts = [(level - 1, last - k * below) for k in range(FAN)]
            path = run_path(out, topic, metric, "parquet", level, last)
            rows = sum(rows_of[b] for b in batches)
            merged = _union(spark, out, topic, metric, parts, schema).repartition(max(1, -(-rows // FILE_ROWS)))
            merged.write.mode("overwrite").parquet(path)
            found = spark.read.schema(schema).parquet(path).count()
            if found != rows:
                raise RuntimeError(f"{found} rows in a run of {metric}, {rows} in its batches")
            commits.commit(spark, place, last, query, {metric: found}, None, started, datetime.now(timezone.utc))
            made.append((level, last))
        level += 1
    return made


def results(spark: SparkSession, out: str, topic: str, metric: str) -> DataFrame:
    """The rows of whole batches, from as few files as there are."""
    runs = current_runs(spark, out, topic, metric)
    if not runs:
        return commits.results(spark, out, topic, metric)
    return _union(spark, out, topic, metric, runs, _schema(spark, out, topic, metric, runs[0]))


def replaced(spark: SparkSession, out: str, topic: str, metric: str) -> list[str]:
    """Folders of batches and runs that larger runs have replaced."""
    runs = current_runs(spark, out, topic, metric)
    old = []
    for level, last in runs:
        for lower in range(level):
            step = FAN**lower
            first = last - FAN**level + step
            old += [run_path(out, topic, metric, "parquet", lower, b) for b in range(first, last + 1, step)]
    return old
