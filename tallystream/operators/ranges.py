"""IP range tables: checks, and the cut into buckets that messages are joined on."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.schema import GEO_FIELDS, GEO_STRUCT, RANGE_SCHEMA

MAX_IPV4 = (1 << 32) - 1

# A bucket holds 2**16 addresses. Buckets with more than 256 ranges are cut again
# into buckets of 2**8 addresses, which hold at most 256 disjoint ranges.
BUCKET_BITS = 16
FINE_BITS = 8
CROWDED = 256

MAX_BROADCAST_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class RangeIndex:
    """Disjoint ranges, and their cut for a broadcast join if that is small enough.

    ``coarse`` holds the calm buckets and ``fine`` the pieces of the crowded ones;
    ``fine`` is None without crowded buckets and ``coarse`` is None where the
    tables are too large to broadcast.
    """

    ranges: DataFrame
    coarse: DataFrame | None = None
    fine: DataFrame | None = None
    frozen: bool = False  # read from a written version


def cut_at_buckets(ranges: DataFrame, shift: int) -> DataFrame:
    """One row per range and bucket of ``2**shift`` addresses, clipped to the bucket.

    Disjoint ranges give at most one row per range and one per bucket in all. A
    row that is no IPv4 range comes out once, with a NULL bucket.
    """
    valid = (F.col("lo") >= 0) & (F.col("lo") <= F.col("hi")) & (F.col("hi") <= MAX_IPV4)
    buckets = F.when(valid, F.sequence(F.shiftright("lo", shift), F.shiftright("hi", shift)))
    cut = ranges.withColumn("bucket", F.explode_outer(buckets))
    start = F.shiftleft("bucket", shift)
    return cut.select(
        "bucket",
        F.greatest("lo", start).alias("lo"),
        F.least(F.col("hi"), start + F.lit((1 << shift) - 1)).alias("hi"),
        "geo",
        (F.col("hi") - F.col("lo")).alias("width"),
        F.col("lo").alias("first"),
    )


def _bucket_profile(pieces: DataFrame) -> DataFrame:
    """Per bucket: its ranges, their size in memory, and whether one begins before
    an earlier one has ended."""
    earlier = (
        Window.partitionBy("bucket").orderBy("lo", "hi")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    row_bytes = F.lit(64) + F.coalesce(F.octet_length(F.to_json("geo")), F.lit(0))
    crosses = F.coalesce(F.max("hi").over(earlier) >= F.col("lo"), F.lit(False))
    return (
        pieces.select("bucket", crosses.alias("crosses"), row_bytes.alias("size"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.bool_or("crosses").alias("crosses"))
    )


def _sweeper():
    """The task function, nested so that it travels to executors by value."""
    geo_fields = list(GEO_FIELDS)

    def sweep(pdf: pd.DataFrame) -> pd.DataFrame:
        """Disjoint pieces of one bucket, each given to its narrowest range; of several
        such ranges to the first by start and place, whatever the order of rows."""
        pdf = pdf.sort_values(["lo", "hi", "width", "first", "place"], kind="stable")
        lo, hi, width = pdf["lo"].to_numpy(), pdf["hi"].to_numpy(), pdf["width"].to_numpy()
        tie = list(zip(pdf["first"].tolist(), pdf["place"].tolist(), strict=True))
        edges = sorted(set(lo.tolist()) | set((hi + 1).tolist()))
        active, begun, pieces = [], 0, []
        for start, end in zip(edges, edges[1:]):
            while begun < len(lo) and lo[begun] <= start:
                heapq.heappush(active, (width[begun], *tie[begun], begun))
                begun += 1
            while active and hi[active[0][-1]] < start:
                heapq.heappop(active)
            if active:
                pieces.append((start, end - 1, active[0][-1]))
        chosen = pdf.iloc[[p[2] for p in pieces]].reset_index(drop=True)
        chosen["lo"] = [p[0] for p in pieces]
        chosen["hi"] = [p[1] for p in pieces]
        return chosen[["lo", "hi", *geo_fields]]

    return sweep


def keep_narrowest(ranges: DataFrame, crossing: DataFrame) -> DataFrame:
    """Disjoint ranges with the same answers; only ``crossing`` buckets are swept."""
    pieces = cut_at_buckets(ranges, BUCKET_BITS)
    calm = pieces.join(crossing, "bucket", "left_anti").select("lo", "hi", "geo")
    # Ranges with equal ends inside a bucket collapse to the narrowest before
    # the bucket is handed to one task.
    place = F.coalesce(F.to_json("geo"), F.lit(""))
    swept = (
        pieces.join(crossing, "bucket", "left_semi")
        .groupBy("bucket", "lo", "hi")
        .agg(F.min_by(F.struct("width", "first", place.alias("place"), "geo"), F.struct("width", "first", place)).alias("m"))
        .select("bucket", "lo", "hi", "m.width", "m.first", "m.place", "m.geo.*")
        .groupBy("bucket")
        .applyInPandas(
            _sweeper(), T.StructType([*RANGE_SCHEMA.fields[:2], *GEO_STRUCT.fields])
        )
        .select("lo", "hi", F.struct(*GEO_FIELDS).alias("geo"))
    )
    return calm.unionByName(swept)


def index_ranges(
    ranges: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES, on_overlap: str = "narrowest"
) -> RangeIndex:
    """Checks a range table (``lo, hi, geo``) once, before any message is read.

    Overlapping ranges raise with ``on_overlap="error"``, else the narrowest wins.
    """
    if on_overlap not in ("narrowest", "error"):
        raise ValueError(f"on_overlap must be 'narrowest' or 'error', not {on_overlap!r}")
    ranges = ranges.select("lo", "hi", "geo")

    def measure(pieces: DataFrame):
        return _bucket_profile(pieces).agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
            F.coalesce(F.max("n"), F.lit(0)).alias("fullest"),
            F.coalesce(F.bool_or("crosses"), F.lit(False)).alias("crosses"),
            F.coalesce(F.max(F.when(F.col("bucket").isNull(), F.col("n"))), F.lit(0)).alias("invalid"),
        ).first()

    pieces = cut_at_buckets(ranges, BUCKET_BITS)
    found = measure(pieces)
    if found["invalid"]:
        raise ValueError(f"{found['invalid']} rows are not an IPv4 range")
    if found["crosses"]:
        if on_overlap == "error":
            raise ValueError("IP ranges overlap")
        crossing = _bucket_profile(pieces).where("crosses").select("bucket")
        ranges = keep_narrowest(ranges, crossing)
        pieces = cut_at_buckets(ranges, BUCKET_BITS)
        found = measure(pieces)

    if found["size"] > max_broadcast_bytes:
        return RangeIndex(ranges)
    if found["fullest"] <= CROWDED:
        return RangeIndex(ranges, pieces)
    crowded = _bucket_profile(pieces).where(F.col("n") > CROWDED).select("bucket")
    coarse = pieces.join(crowded, "bucket", "left_anti")
    fine = cut_at_buckets(pieces.join(crowded, "bucket", "left_semi"), FINE_BITS)
    if found["size"] + measure(fine)["size"] > max_broadcast_bytes:
        return RangeIndex(ranges)
    return RangeIndex(ranges, coarse, fine)
