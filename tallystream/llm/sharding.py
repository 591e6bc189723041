"""Even shards by balanced label propagation over groups of equal texts.

Documents with equal texts are linked. Every document starts in the shard its id hashes
to. In each round the documents of a group look at the shards of their neighbours, the
group as it stands, and move towards the shard most of them are in, as far as that
shard has room; demands are summed up per pair of shards, and the room is shared among
them. Moves are counted per group and shard, since equal texts are interchangeable: a
group with copies is one row with its documents in every shard, and a round is one pass
over these rows, never over pairs of documents.

A last step makes the law exact: shards differ by one document at most. Documents
without links leave an overfull shard before linked ones do.

Defined results: null texts are one group; documents with equal ids and texts are told
apart by number only; an empty table gives an empty result; no document is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystream.llm.common import restart_point, stored

SHARDS = 8
ROUNDS = 6
BINS = 64  # parts in which rows are numbered
GROUP = ["g1", "g2"]


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(17), F.coalesce(text, F.lit("")), text.isNull()).alias("g2")]


def _chance(*parts) -> Column:
    """A number from 0 to 1 that depends on the given values only."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def _accepted_shares(loads: dict[int, int], demand: dict[tuple[int, int], int], room: float) -> dict[int, float]:
    """Which share of the moves into each shard it can take, with the moves out of it counted."""
    shards = range(len(loads))
    share = dict.fromkeys(shards, 1.0)
    for _ in range(50):
        for p in shards:
            incoming = sum(n for (_, to), n in demand.items() if to == p)
            leaving = sum(n * share[to] for (s, to), n in demand.items() if s == p)
            if incoming:
                share[p] = min(1.0, max(0.0, (room - loads[p] + leaving) / incoming))
    return share


def _by_group(counts: DataFrame, n_shards: int) -> DataFrame:
    """One row for each group: ``at`` holds its documents in every shard."""
    in_shards = (F.sum(F.when(F.col("shard") == s, F.col("n")).otherwise(0)) for s in range(n_shards))
    return counts.groupBy(*GROUP).agg(F.array(*in_shards).alias("at"))


def _by_shard(groups: DataFrame) -> DataFrame:
    """``g1, g2, shard, n`` of the shards in which a group has documents."""
    return groups.select(*GROUP, F.posexplode("at").alias("shard", "n")).where("n > 0")


def propagate(spark: SparkSession, counts: DataFrame, loads: dict[int, int], rounds: int = ROUNDS, slack: float = 1.05) -> DataFrame:
    """Moves documents of groups between shards; ``counts`` has ``g1, g2, shard, n``.

    ``loads`` holds the documents of every shard, linked or not, and is the only thing
    that comes to the driver, beside the documents by shard and wish. A group is one row
    here, so that a round looks at each row by itself and shuffles these sums only.
    """
    n_shards = len(loads)
    room = slack * sum(loads.values()) / n_shards
    state = restart_point(spark, _by_group(counts, n_shards))
    alone = None
    for step in range(rounds):
        # Most neighbours first; ties by a hash that changes with the round.
        liking = F.transform("at", lambda n, s: F.struct(n, F.xxhash64(F.lit(step), "g1", s), s.alias("shard")))
        wishes = state.withColumn("best", F.array_max(liking)["shard"])
        sums = wishes.select("best", F.posexplode("at").alias("shard", "n")).where("n > 0").groupBy("shard", "best").agg(F.sum("n").alias("n"))
        held = {(r["shard"], r["best"]): r["n"] for r in sums.orderBy("shard", "best").collect()}
        linked = {s: sum(n for (at, _), n in held.items() if at == s) for s in loads}
        alone = alone or {s: loads[s] - linked[s] for s in loads}
        wanted = {(s, to): n for (s, to), n in held.items() if s != to}
        if not wanted:
            break
        share = _accepted_shares({s: alone[s] + linked[s] for s in loads}, wanted, room)
        accept = F.get(F.array(*(F.lit(share[p]) for p in range(n_shards))), F.col("best"))
        # Small groups move as a whole or not at all, large ones in part.
        wishes = wishes.withColumn("accept", accept).withColumn("whole", _chance(F.lit(step + 100), "g1", "g2") < F.col("accept"))
        part = lambda n: F.when(n >= 32, F.least(n, F.floor(n * F.col("accept") + 0.5))).when(F.col("whole"), n).otherwise(0)
        moved = wishes.withColumn("moving", F.transform("at", lambda n, s: F.when(s == F.col("best"), 0).otherwise(part(n))))
        moved = moved.withColumn("come", F.aggregate("moving", F.lit(0).cast("bigint"), lambda total, n: total + n))
        left = F.zip_with("at", "moving", lambda n, gone: n - gone)
        state = restart_point(spark, moved.select(*GROUP, F.transform(left, lambda n, s: F.when(s == F.col("best"), n + F.col("come")).otherwise(n)).alias("at")))
    return _by_shard(state)


def _numbered(df: DataFrame, keys: list[str], bin_of: Column, order: list[Column], name: str) -> DataFrame:
    """Numbers rows from 0 within ``keys`` by parts: sizes of the parts, then rows within one."""
    binned = df.withColumn("bin", bin_of)
    parts = binned.groupBy(*keys, "bin").agg(F.count("*").alias("c"))
    runs = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("first", F.coalesce(F.sum("c").over(runs), F.lit(0))).drop("c")
    within = F.row_number().over(Window.partitionBy(*keys, "bin").orderBy(*order)) - 1
    return binned.join(parts, [*keys, "bin"]).withColumn(name, F.col("first") + within).drop("bin", "first")


def shards(documents: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: counts of shards differ by one at most."""
    spark = documents.sparkSession
    text = F.col("text")
    start = F.pmod(F.xxhash64(F.lit(19), "doc_id"), F.lit(n_shards)).cast("int")
    docs = documents.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        *_key(text),
        start.alias("start"),
    )
    docs = stored(spark, docs, "sharding-docs")
    groups = _by_group(docs.select(*GROUP, F.col("start").alias("shard"), F.lit(1).alias("n")), n_shards)
    linked = _by_shard(groups.where(F.aggregate("at", F.lit(0).cast("bigint"), lambda total, n: total + n) > 1))
    loads = dict.fromkeys(range(n_shards), 0) | {r["start"]: r["count"] for r in docs.groupBy("start").count().collect()}
    final = propagate(spark, linked, loads)

    # Documents of a group, in order of a hash, fill the places the group has in each shard.
    places = final.withColumn("upto", F.sum("n").over(Window.partitionBy(*GROUP).orderBy("shard"))).withColumn("shard", F.col("shard"))
    slots = places.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("ends"))
    spread = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(BINS))
    order = [F.xxhash64(F.lit(29), "doc_id"), F.col("doc_id"), F.col("size")]
    joined = docs.join(slots, GROUP, "left")
    ranked = _numbered(joined.where("ends IS NOT NULL"), GROUP, spread, order, "k")
    in_group = F.element_at(F.filter("ends", lambda e: e["upto"] > F.col("k")), 1)["shard"]
    columns = ["doc_id", "size", "text_crc32"]
    grouped = ranked.select(*columns, in_group.alias("shard"), F.lit(1).alias("linked"))
    alone = joined.where("ends IS NULL").select(*columns, F.col("start").alias("shard"), F.lit(0).alias("linked"))
    placed = stored(spark, grouped.unionByName(alone), "sharding-placed")

    # Exact evenness: rows beyond a shard's quota, unlinked ones first, fill the gaps of others.
    have = dict.fromkeys(range(n_shards), 0) | {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    total = sum(have.values())
    quota = {s: total // n_shards + (1 if s < total % n_shards else 0) for s in have}
    # Linked rows come first, so the rows beyond the quota are unlinked as far as there are any.
    bins = (1 - F.col("linked")) * BINS + F.pmod(F.xxhash64(F.lit(31), "doc_id"), F.lit(BINS))
    numbered = _numbered(placed, ["shard"], bins, [F.xxhash64(F.lit(37), "doc_id"), F.col("doc_id"), F.col("size"), F.col("text_crc32")], "slot")
    limit = F.get(F.array(*(F.lit(quota[s]) for s in range(n_shards))), F.col("shard"))
    surplus_before, gaps, running = [], [], 0
    for s in range(n_shards):
        surplus_before.append(running)
        running += max(0, have[s] - quota[s])
    running = 0
    for s in range(n_shards):
        if have[s] < quota[s]:
            gaps.append((running, s, have[s]))
            running += quota[s] - have[s]
    over = F.col("slot") - limit + F.get(F.array(*(F.lit(x) for x in surplus_before)), F.col("shard"))
    to, at = F.col("shard"), F.col("slot")
    for first, s, filled in gaps:  # later gaps override earlier ones
        there = (F.col("slot") >= limit) & (over >= first)
        to = F.when(there, F.lit(s)).otherwise(to)
        at = F.when(there, over - first + filled).otherwise(at)
    return numbered.select(*columns, to.cast("int").alias("shard"), at.cast("bigint").alias("slot"))


def report(documents: DataFrame) -> DataFrame:
    """Shard and slot of every document under the law of equal counts."""
    placed = shards(documents)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
