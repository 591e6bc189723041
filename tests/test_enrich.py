"""IP enrichment against brute force over the range list."""

from __future__ import annotations

import ipaddress
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallystream.functions.ip import ipv4_to_long
from tallystream.operators import enrich
from tallystream.operators.ranges import CROWDED, RangeIndex, index_ranges
from tallystream.schema import GEO_FIELDS, RANGE_SCHEMA

ADDRESSES = [
    "0.0.0.0", "255.255.255.255", "1.2.3.4", "10.0.0.1", "256.1.1.1", "1.2.3", "1.2.3.4.5", "1.2.3.04",
    "01.2.3.4", " 1.2.3.4", "1.2.3.4\n", "+1.2.3.4", "1.2.3.-4", "1..3.4", "", "a.b.c.d", "::1",
    "2001:db8::1", "1.2.3.4/8", "٣.2.3.4", None,
]


def as_number(text):
    try:
        return int(ipaddress.IPv4Address(text)) if text is not None else None
    except ValueError:
        return None


def geo(name):
    return tuple(name if f == "city" else None for f in GEO_FIELDS)


def range_table(spark, triples):
    return spark.createDataFrame([(lo, hi, geo(n)) for lo, hi, n in triples], RANGE_SCHEMA)


def users(spark, addresses):
    return spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "id int, ip_address string")


def narrowest(triples, number):
    hits = [(hi - lo, lo, n) for lo, hi, n in triples if number is not None and lo <= number <= hi]
    return min(hits)[2] if hits else None


def answers(enriched):
    rows = enriched.select("id", F.col("geo.city").alias("city")).collect()
    return [r["city"] for r in sorted(rows, key=lambda r: r["id"])]


def test_ipv4_to_long(spark):
    df = users(spark, ADDRESSES).select("id", ipv4_to_long(F.col("ip_address")).alias("n"))
    assert [r["n"] for r in sorted(df.collect())] == [as_number(a) for a in ADDRESSES]


def disjoint(rng, n, top):
    cuts = sorted(rng.sample(range(top), 2 * n))
    return [(cuts[2 * i], cuts[2 * i + 1], f"r{i}") for i in range(n)]


def probes(rng, triples):
    edges = [e for lo, hi, _ in triples for e in (lo - 1, lo, hi, hi + 1)]
    numbers = rng.sample(edges, min(300, len(edges))) + [rng.randrange(1 << 32) for _ in range(50)]
    numbers = [n for n in numbers if 0 <= n < 1 << 32]
    return [str(ipaddress.IPv4Address(n)) for n in numbers] + ADDRESSES


CASES = {
    "wide": lambda rng: disjoint(rng, 40, 1 << 32),
    "whole": lambda rng: [(0, (1 << 32) - 1, "all")],
    "crowded": lambda rng: disjoint(rng, 4 * CROWDED, 1 << 16) + [(1 << 16, 1 << 28, "rest")],
    "single": lambda rng: [(n, n, f"s{n}") for n in range(100, 400)],
    "none": lambda rng: [],
}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("form", ["broadcast", "sorted"])
def test_forms_agree_with_brute_force(spark, case, form):
    rng = random.Random(case)
    triples = CASES[case](rng)
    asked = probes(rng, triples)
    index = index_ranges(range_table(spark, triples), on_overlap="error")
    assert index.coarse is not None
    assert (index.fine is not None) == (case in ("crowded", "single"))
    if form == "sorted":
        index = RangeIndex(index.ranges)
    got = answers(enrich.ip_enrich(users(spark, asked), index))
    assert got == [narrowest(triples, as_number(a)) for a in asked]


def test_large_table_is_not_broadcast(spark):
    triples = [(0, 99, "a"), (200, 299, "b")]
    index = index_ranges(range_table(spark, triples), max_broadcast_bytes=100)
    assert index.coarse is None
    plan = enrich.ip_enrich(users(spark, ADDRESSES), index)
    assert answers(plan) == [narrowest(triples, as_number(a)) for a in ADDRESSES]


@pytest.mark.parametrize("form", ["broadcast", "sorted"])
def test_columns_of_the_messages_stay(spark, form):
    ranges = range_table(spark, [(0, 1 << 30, "a")])
    df = spark.createDataFrame([("1.1.1.1", 1, 2, 3, 4)], "ip_address string, bucket int, lo int, hi int, at int")
    index = index_ranges(ranges) if form == "broadcast" else RangeIndex(ranges)
    row = enrich.ip_enrich(df, index).first()
    assert tuple(row)[:5] == ("1.1.1.1", 1, 2, 3, 4) and row["geo"]["city"] == "a"


def test_overlaps(spark):
    rng = random.Random(7)
    triples = [(0, (1 << 24) - 1, "w0"), (1 << 20, 1 << 21, "w1"), (5 << 16, (5 << 16) + 9, "w2")]
    triples += [(lo, lo + rng.randrange(1 << rng.randrange(1, 20)), f"x{i}")
                for i, lo in enumerate(rng.sample(range(1 << 22), 80))]
    ranges = range_table(spark, triples)
    with pytest.raises(ValueError, match="overlap"):
        index_ranges(ranges, on_overlap="error")
    asked = probes(rng, triples)
    got = answers(enrich.ip_enrich(users(spark, asked), ranges))
    assert got == [narrowest(triples, as_number(a)) for a in asked]


@pytest.mark.parametrize("lo, hi", [(5, 4), (-1, 3), (0, 1 << 32)])
def test_bad_range(spark, lo, hi):
    with pytest.raises(ValueError, match="1 rows are not an IPv4 range"):
        index_ranges(range_table(spark, [(lo, hi, "a"), (7, 8, "b")]))


def test_lookup_asks_each_address_once(spark, tmp_path):
    log = str(tmp_path)

    def lookup(addresses):
        import uuid
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(addresses))
        return pd.DataFrame({"city": ["c" + a for a in addresses], "country": None})

    asked = ["1.1.1.1"] * 50 + ["2.2.2.2", "::1", None]
    got = answers(enrich.lookup_enrich(users(spark, asked), lookup, partitions=3))
    assert got == [None if a is None else "c" + a for a in asked]
    seen = [line for p in tmp_path.iterdir() for line in p.read_text().split("\n") if line]
    assert sorted(seen) == ["1.1.1.1", "2.2.2.2", "::1"]


@pytest.mark.parametrize("form", ["sorted", "lookup"])
def test_skewed_address_is_split(spark, form):
    """One address in a third of the rows: adaptive execution reads its partition in pieces."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, "9.9.9.9")
        ip = hot.otherwise(F.concat_ws(".", F.lit("8"), F.col("id") % 50, F.col("id") % 200, F.lit("1")))
        df = spark.range(0, 60_000, numPartitions=8).withColumn("ip_address", ip)
        triples = [(9 << 24, (10 << 24) - 1, "hot"), (8 << 24, (8 << 24) + (1 << 20) - 1, "cool")]
        if form == "sorted":
            out = enrich.ip_enrich(df, RangeIndex(range_table(spark, triples)))
        else:
            def lookup(ips):
                second = ips.str.split(".").str[1].astype(int)
                hot, cool = ips.str.startswith("9."), ips.str.startswith("8.") & (second < 16)
                city = pd.Series(None, index=ips.index, dtype=object)
                return pd.DataFrame({"city": city.mask(hot, "hot").mask(cool, "cool")})

            out = enrich.lookup_enrich(df, lookup)
        rows = out.groupBy("geo.city").count().collect()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        expected = {}
        for i in range(60_000):
            a = "9.9.9.9" if i % 3 == 0 else f"8.{i % 50}.{i % 200}.1"
            name = narrowest(triples, as_number(a))
            expected[name] = expected.get(name, 0) + 1
        assert {r["city"]: r["count"] for r in rows} == expected
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
