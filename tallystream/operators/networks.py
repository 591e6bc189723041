"""Networks of both address families, found by longest prefix.

A bucket of fixed length, as IPv4 ranges have it, does not exist for 128 bits. Networks
are keyed by their prefix and its length; an address is looked up once for every length
that occurs in the table, as an equality join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.functions.ip import FAMILIES, ip_key, key_prefix

MAX_BROADCAST_BYTES = 256 * 1024 * 1024
MAX_PROBES = 48  # map-side joins one after the other; beyond, addresses are shuffled


@dataclass(frozen=True)
class NetworkIndex:
    """``prefix, bits, geo``, one row per network, and the (family, bits) that occur, longest first."""

    networks: DataFrame
    lengths: tuple[tuple[str, int], ...]
    broadcast: bool
    frozen: bool = False  # read from a written version


def _parsed(networks: DataFrame) -> DataFrame:
    """Family, length and prefix of networks written ``address/length``; an address alone is a network of its own."""
    key = ip_key(F.substring_index("network", "/", 1))
    given = F.when(F.col("network").contains("/"), F.substring_index("network", "/", -1)).otherwise("")
    rows = networks.select("geo", F.explode(F.array(key)).alias("key"), given.alias("given"), F.col("network").contains(":").alias("six"))
    most = F.when(F.col("six"), FAMILIES["6"]).otherwise(FAMILIES["4"])
    own = F.when(F.col("given") == "", most).when(F.col("given").rlike(r"\A[0-9]{1,3}\z"), F.col("given").cast("int"))
    # A network of IPv4 addresses written in IPv6 is that IPv4 network.
    mapped = F.col("six") & F.col("key").startswith("4")
    bits = F.when(mapped, own - 96).otherwise(own)
    rows = rows.select("geo", "key", F.when((own <= most) & (bits >= 0), bits).alias("bits"))
    return rows.select("geo", F.left("key", F.lit(1)).alias("family"), "bits", key_prefix(F.col("key"), F.col("bits")).alias("prefix"))


def index_networks(networks: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> NetworkIndex:
    """Checks a table ``network, geo`` once. Of networks given twice the first by the text of ``geo`` counts."""
    rows = _parsed(networks)
    text = F.coalesce(F.to_json("geo"), F.lit(""))
    kept = rows.groupBy("family", "bits", "prefix").agg(F.min_by("geo", text).alias("geo"))
    size = F.lit(96) + F.coalesce(F.octet_length(F.to_json("geo")), F.lit(0))
    found = kept.agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("size"), F.collect_set(F.struct("family", "bits")).alias("lengths"),
        F.count_if(F.col("prefix").isNull()).alias("invalid"),
    ).first()
    if found["invalid"]:
        raise ValueError("rows that are no network")
    lengths = tuple(sorted(((r["family"], r["bits"]) for r in found["lengths"]), key=lambda r: (r[0], -r[1])))
    small = found["size"] <= max_broadcast_bytes and len(lengths) <= MAX_PROBES
    return NetworkIndex(kept.select("family", "bits", "prefix", "geo"), lengths, small)


def _probe_broadcast(df: DataFrame, index: NetworkIndex, key: Column) -> DataFrame:
    """One map-side join per length, the longest first. No message is shuffled."""
    # explode keeps the parse of the address in one place, as in decoding.
    located = df.withColumn("_key", F.explode(F.array(key)))
    names = []
    for family, bits in index.lengths:
        name = f"_geo_{family}_{bits}"
        rows = index.networks.where((F.col("family") == family) & (F.col("bits") == bits))
        side = rows.select(F.col("prefix").alias("_prefix"), F.col("geo").alias(name))
        own = F.when(F.col("_key").startswith(family), key_prefix(F.col("_key"), F.lit(bits)))
        located = located.join(F.broadcast(side), own == F.col("_prefix"), "left").drop("_prefix")
        names.append(name)
    none = F.lit(None).cast(index.networks.schema["geo"].dataType)
    return located.withColumn("geo", F.coalesce(*names, none))


def _probe_shuffled(df: DataFrame, index: NetworkIndex, key: Column) -> DataFrame:
    """Every distinct address meets the networks of each length by an equality join; the
    longest one's place joins the messages on the address."""
    # What is no address matches nothing; numbered, such rows spread over the tasks.
    nothing = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    keyed = df.withColumn("_key", F.explode(F.array(key))).withColumn("_key", F.coalesce("_key", nothing))
    lengths = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(b).alias("bits")) for f, b in index.lengths))
    asked = df.select(F.explode(F.array(key)).alias("_key")).where("_key IS NOT NULL").distinct()
    asked = asked.select("_key", F.explode(F.filter(lengths, lambda x: F.col("_key").startswith(x["family"]))).alias("n"))
    asked = asked.select("_key", F.col("n.family").alias("family"), F.col("n.bits").alias("bits"), key_prefix(F.col("_key"), F.col("n.bits")).alias("prefix"))
    met = asked.join(index.networks, ["family", "bits", "prefix"])
    answers = met.groupBy("_key").agg(F.max_by("geo", "bits").alias("geo"))
    return keyed.join(answers, "_key", "left")


def locate(df: DataFrame, index: NetworkIndex, address: str = "ip_address") -> DataFrame:
    """Adds ``geo`` of the longest network that holds the address, else NULL; every row stays."""
    none = F.lit(None).cast(index.networks.schema["geo"].dataType)
    if not index.lengths:
        return df.withColumn("geo", none)
    probe = _probe_broadcast if index.broadcast else _probe_shuffled
    return probe(df, index, ip_key(F.col(address))).select(*df.columns, "geo")
