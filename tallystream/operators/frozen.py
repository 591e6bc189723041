"""Range and network indexes written once, with a version, and read by every batch.

An index made in a job is a plan: every micro-batch would cut (and sweep) the ranges
again. A version is complete once its description is there, which is written last;
readers take the newest complete one, or the one they name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.operators.networks import NetworkIndex
from tallystream.operators.ranges import RangeIndex
from tallystream.schema import GEO_STRUCT, RANGE_SCHEMA
from tallystream.workspace import table_or_empty

Index = RangeIndex | NetworkIndex

DESCRIPTION = "kind string, tables array<string>, lengths array<struct<family string, bits int>>, broadcast boolean, built timestamp"

_PIECES = f"bucket bigint, lo bigint, hi bigint, geo {GEO_STRUCT.simpleString()}, width bigint, first bigint"
_SCHEMAS = {
    "ranges": RANGE_SCHEMA, "coarse": _PIECES, "fine": _PIECES,
    "networks": f"family string, bits int, prefix string, geo {GEO_STRUCT.simpleString()}",
}


def _tables(index: Index) -> dict[str, DataFrame]:
    names = ("networks",) if isinstance(index, NetworkIndex) else ("ranges", "coarse", "fine")
    return {n: getattr(index, n) for n in names if getattr(index, n) is not None}


def versions(spark: SparkSession, path: str) -> DataFrame:
    """``version, kind, tables, lengths, broadcast, built`` of the complete versions."""
    schema = f"version bigint, {DESCRIPTION}"
    return table_or_empty(spark, f"{path}/versions", lambda p: spark.read.schema(schema).parquet(p), schema)


def save(spark: SparkSession, index: Index, path: str) -> int:
    """Writes a new version and gives its number."""
    last = versions(spark, path).agg(F.max("version")).first()[0]
    version = 0 if last is None else last + 1
    tables = _tables(index)
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}/version={version}")
    kind = type(index).__name__
    lengths = list(index.lengths) if isinstance(index, NetworkIndex) else []
    broadcast = isinstance(index, NetworkIndex) and index.broadcast
    row = spark.createDataFrame([(kind, list(tables), lengths, broadcast)], DESCRIPTION.rsplit(",", 1)[0])
    row = row.withColumn("built", F.current_timestamp()).coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/versions/version={version}")
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> Index:
    """A complete version, the newest one if none is named."""
    found = versions(spark, path)
    found = found.where(F.col("version") == version) if version is not None else found
    row = found.orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"no such index: {path}, version {version}")
    read = {n: spark.read.schema(_SCHEMAS[n]).parquet(f"{path}/{n}/version={row['version']}") for n in row["tables"]}
    if row["kind"] == "NetworkIndex":
        lengths = tuple((r["family"], r["bits"]) for r in row["lengths"])
        return NetworkIndex(read["networks"], lengths, row["broadcast"], frozen=True)
    return RangeIndex(read["ranges"], read.get("coarse"), read.get("fine"), frozen=True)


def freeze(spark: SparkSession, index: Index, path: str) -> Index:
    """The index read from a new version, or itself if it has been read from one."""
    return index if index.frozen else load(spark, path, save(spark, index, path))
