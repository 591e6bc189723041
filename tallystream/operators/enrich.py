"""Place data for the IP address of every message; every message keeps its row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.functions.ip import ipv4_to_long
from tallystream.operators.networks import NetworkIndex, locate
from tallystream.operators.ranges import (
    BUCKET_BITS, FINE_BITS, RangeIndex, cut_at_buckets, index_ranges,
)
from tallystream.schema import GEO_FIELDS, GEO_STRUCT
from tallystream.workspace import table_or_empty

Lookup = Callable[[pd.Series], pd.DataFrame]


def _probe(df: DataFrame, pieces: DataFrame, shift: int, name: str) -> DataFrame:
    """Map-side join on the bucket of the address, range ends as further condition."""
    side = pieces.select(
        F.col("bucket").alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
        F.col("geo").alias(name),
    )
    at = F.shiftright("_ip", shift) == F.col("_bucket")
    inside = F.col("_ip").between(F.col("_lo"), F.col("_hi"))
    return df.join(F.broadcast(side), at & inside, "left").drop("_bucket", "_lo", "_hi")


def _probe_broadcast(df: DataFrame, index: RangeIndex) -> DataFrame:
    """For range tables whose size was checked. No message is shuffled."""
    located = _probe(df, index.coarse, BUCKET_BITS, "geo")
    if index.fine is None:
        return located
    finer = _probe(located, index.fine, FINE_BITS, "_fine")
    return finer.withColumn("geo", F.coalesce("geo", "_fine"))


def _probe_sorted(df: DataFrame, index: RangeIndex) -> DataFrame:
    """For range tables too large to broadcast.

    Every distinct address is lined up with the range starts of its bucket; the
    last start before it is the only range that can hold it. A bucket has at
    most 2**16 addresses and 2**16 starts. The answers then join the messages
    on the address.
    """
    addresses = df.where(F.col("_ip").isNotNull()).select("_ip").distinct()
    starts = cut_at_buckets(index.ranges, BUCKET_BITS).select(
        "bucket", F.col("lo").alias("at"), F.lit(0).alias("is_address"), F.struct("hi", "geo").alias("r")
    )
    asked = addresses.select(
        F.shiftright("_ip", BUCKET_BITS).alias("bucket"), F.col("_ip").alias("at"),
        F.lit(1).alias("is_address"), F.lit(None).cast(starts.schema["r"].dataType).alias("r"),
    )
    line = (
        Window.partitionBy("bucket").orderBy("at", "is_address")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        asked.unionByName(starts)
        .withColumn("r", F.last("r", ignorenulls=True).over(line))
        .where((F.col("is_address") == 1) & (F.col("at") <= F.col("r.hi")))
        .select(F.col("at").alias("_ip"), F.col("r.geo").alias("geo"))
    )
    return df.withColumn("_ip", F.coalesce("_ip", -_number())).join(answers, "_ip", "left")


def _number() -> Column:
    """A key for rows that match nothing: all as NULL would meet in one task of the join."""
    return F.monotonically_increasing_id() + 1


def ip_enrich(df: DataFrame, ranges: DataFrame | RangeIndex | NetworkIndex) -> DataFrame:
    """Adds ``geo``. NULL for addresses in no range and, under a range table, for those that
    are not IPv4; networks are of both families, the longest wins.

    The ranges are disjoint, so a message matches at most one. An index made once by
    ``index_ranges`` or ``index_networks`` and frozen can serve many micro-batches.
    """
    if isinstance(ranges, NetworkIndex):
        return locate(df, ranges)
    index = ranges if isinstance(ranges, RangeIndex) else index_ranges(ranges)
    probe = _probe_sorted if index.coarse is None else _probe_broadcast
    located = probe(df.withColumn("_ip", ipv4_to_long(F.col("ip_address"))), index)
    return located.select(*df.columns, "geo")


def _asked(addresses: DataFrame, lookup: Lookup, partitions: int | None) -> DataFrame:
    """``ip_address, geo`` for distinct addresses, from a function of the caller."""
    if partitions is not None:
        addresses = addresses.repartition(partitions, "ip_address")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = lookup(batch["ip_address"]).reindex(columns=list(GEO_FIELDS)).astype(object)
            found = found.where(found.notna(), None)
            found.insert(0, "ip_address", batch["ip_address"].to_numpy())
            yield found

    schema = T.StructType([T.StructField("ip_address", T.StringType()), *GEO_STRUCT.fields])
    return addresses.mapInPandas(ask, schema).select("ip_address", F.struct(*GEO_FIELDS).alias("geo"))


def _with_answers(df: DataFrame, answers: DataFrame) -> DataFrame:
    # A number is no address, so rows without one are spread and match nothing.
    key = F.coalesce("ip_address", F.concat(F.lit("-"), _number().cast("string")))
    side = answers.select(F.col("ip_address").alias("_address"), F.col("geo"))
    return df.withColumn("_key", key).join(side, F.col("_key") == F.col("_address"), "left").select(*df.columns, "geo")


def lookup_enrich(df: DataFrame, lookup: Lookup, partitions: int | None = None) -> DataFrame:
    """Adds ``geo`` from a function of the caller, asked once per distinct address.

    ``lookup`` takes a series of addresses and gives a frame of place fields in
    the same order; fields it leaves out are NULL. ``partitions`` sets how many
    tasks ask at a time, which matters when a call waits for a service.
    """
    addresses = df.where(F.col("ip_address").isNotNull()).select("ip_address").distinct()
    return _with_answers(df, _asked(addresses, lookup, partitions))


PLACE = f"ip_address string, geo {GEO_STRUCT.simpleString()}, asked_at timestamp"


class PlaceTable:
    """Answers of a lookup kept below a folder, so an address is asked once over many batches.

    A batch asks for the addresses that the table lacks or whose answers are older than
    ``max_age`` seconds, adds them, and joins. One batch at a time may write. ``compact``
    writes the latest answers as a new generation, which counts from then on.
    """

    def __init__(self, path: str, lookup: Lookup, max_age: float | None = None, partitions: int | None = None):
        self.path, self.lookup, self.max_age, self.partitions = path, lookup, max_age, partitions

    def _generation(self, spark: SparkSession) -> int:
        schema = "generation bigint, rows bigint"
        known = table_or_empty(spark, f"{self.path}/generations", lambda p: spark.read.schema(schema).parquet(p), schema)
        return known.agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]

    def _folder(self, spark: SparkSession) -> str:
        return f"{self.path}/places/{self._generation(spark)}"

    def _latest(self, spark: SparkSession, folder: str, now: datetime | None) -> DataFrame:
        rows = table_or_empty(spark, folder, lambda p: spark.read.schema(PLACE).parquet(p), PLACE)
        if now is not None and self.max_age is not None:
            rows = rows.where(F.col("asked_at") > F.lit(now - timedelta(seconds=self.max_age)))
        latest = rows.groupBy("ip_address").agg(F.max(F.struct("asked_at", "geo")).alias("m"))
        return latest.select("ip_address", "m.geo", "m.asked_at")

    def known(self, spark: SparkSession, now: datetime | None = None) -> DataFrame:
        """``ip_address, geo, asked_at``: the latest answer of each address, if young enough at ``now``."""
        return self._latest(spark, self._folder(spark), now)

    def enrich(self, df: DataFrame, now: datetime) -> DataFrame:
        """Adds ``geo``; what is not known is asked for and kept before the rows are joined."""
        spark = df.sparkSession
        folder = self._folder(spark)
        addresses = df.where(F.col("ip_address").isNotNull()).select("ip_address").distinct()
        missing = addresses.join(self._latest(spark, folder, now), "ip_address", "left_anti")
        found = _asked(missing, self.lookup, self.partitions).withColumn("asked_at", F.lit(now).cast("timestamp"))
        found.write.mode("append").parquet(folder)
        return _with_answers(df, self._latest(spark, folder, now))

    def compact(self, spark: SparkSession) -> None:
        """The latest answers in a new generation of few files."""
        generation = self._generation(spark)
        target = f"{self.path}/places/{generation + 1}"
        self._latest(spark, f"{self.path}/places/{generation}", None).write.mode("overwrite").parquet(target)
        rows = spark.read.schema(PLACE).parquet(target).count()
        done = spark.createDataFrame([(rows,)], "rows bigint").coalesce(1)
        done.write.mode("overwrite").parquet(f"{self.path}/generations/generation={generation + 1}")


def ip_rows(enriched: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return enriched.select(*keys, "email", "ip_address", "geo")
