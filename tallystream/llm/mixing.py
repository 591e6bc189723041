"""Mixing sources to target weights by entropy balancing.

Each source gets a target in words. Document rates r minimise the relative entropy to
one copy each, under one token constraint per source (rate times size sums to the
target) and the bound of ``most`` copies. The dual solution is an exponential tilt by
size, ``min(most, exp(lambda * size / mean))``, with one lambda per source, found by
Newton steps that are kept inside a bracket. A step is one aggregation over the sizes
that occur and one join with the current lambdas; documents are not read again.

Rates become whole copies by systematic rounding in order of size: extras follow the
cumulated fractions, so the words taken from a source miss the target by no more than
the size of one of its documents. Which of several documents of one size get the extra
copy is decided by a hash of the id.

Defined results: null texts have size 0, and documents of size 0 are taken once where
whole documents are mixed and count for nothing; null sources are one source, sorted
last; repeated rows are documents of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystream.llm.common import stored, word_count

WEIGHTS = (1, 2, 3)
MOST = 3
BINS = 64  # parts of the documents of one size, so that a busy size is numbered in parallel
STEPS = 60


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Adds ``target`` to one row per source (``source, source_size``).

    All sizes are shared by weight. A share stops at ``most`` times the source's size;
    what is left goes to the others by weight until none is above. That is the water
    level at which the capped shares add up to the total, found by sorting the sources
    by the level at which each is full.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = sources.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * most).withColumn("full", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("full", F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everyone = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everyone).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # The level if all sources before this one are full and this one and later ones are not.
    ranked = ranked.withColumn("level", left / rest)
    ranked = ranked.withColumn("place", F.row_number().over(by_level))
    first = F.min(F.when(F.col("level") <= F.col("full"), F.struct("place", "level"))).over(everyone)
    ranked = ranked.withColumn("water", first["level"])
    return ranked.select("source", "source_size", F.least(F.col("cap"), F.coalesce("water", "full") * F.col("weight")).alias("target"))


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined on the source, null with null. The right key is renamed first: frames that
    come from each other share their columns, and dropping one would take the other."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def solve(spark: SparkSession, sizes: DataFrame, targets: DataFrame, most: float = MOST, tolerance: float = 1e-7) -> DataFrame:
    """``source, source_size, target, mean, lam`` with the tilt of each source.

    ``sizes`` has ``source, size, n`` (positive sizes). A source that needs its bound
    everywhere has that tilt at once, one without a positive size has none. A source that
    the steps cannot solve stops the job.
    """
    ranges = sizes.groupBy("source").agg(F.min("size").alias("least"), (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = _by_source(targets, ranges, "left")
    # At the upper end every rate is at its bound; at the lower end all rates are near nothing.
    state = state.withColumn("hi", F.lit(math.log(most)) * F.col("mean") / F.col("least")).withColumn("lo", F.lit(-60.0) * F.col("mean") / F.col("least"))
    bound = F.col("target") >= most * F.col("source_size")
    state = state.withColumn("lam", F.when(bound, F.col("hi")).otherwise(0.0)).withColumn("miss", F.lit(1.0)).drop("least")
    state = stored(spark, state, "mixing-state")
    worst = None
    for _ in range(STEPS):
        now = _by_source(sizes, state)
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(most)), F.exp(F.col("lam") * x))
        free = F.exp(F.col("lam") * x) < most
        words = F.col("n") * F.col("size")
        sums = now.groupBy("source").agg(F.sum(words * rate).alias("got"), F.sum(F.when(free, words * rate * x).otherwise(0.0)).alias("slope"))
        step = _by_source(state, sums, "left")
        gap = F.col("target") - F.coalesce("got", F.lit(0.0))
        lo = F.when(gap > 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("hi"))
        step = step.withColumn("gap", gap).withColumn("lo", lo).withColumn("hi", hi)
        newton = F.col("lam") + F.col("gap") / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (newton > F.col("lo")) & (newton < F.col("hi"))
        moved = F.when(F.col("mean").isNull() | (F.col("gap") == 0), F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        miss = F.when(F.col("mean").isNull(), 0.0).otherwise(F.abs("gap") / F.greatest(F.col("target"), F.lit(1.0)))
        narrow = F.col("hi") - F.col("lo") < 1e-12
        # A table, not a checkpoint: that would keep the size Spark expects of the joins, a
        # product which a loop raises to numbers of millions of digits.
        step = step.select("source", "source_size", "target", "mean", "lo", "hi", moved.alias("lam"), F.when(narrow, 0.0).otherwise(miss).alias("miss"))
        state = stored(spark, step, "mixing-state")
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst <= tolerance:
            break
    else:
        raise ArithmeticError(f"rates miss a target by {worst:.1e} of it after {STEPS} steps")
    return state.select("source", "source_size", "target", "mean", "lam")


def _sum_before(column: str, within: list[str], order: str) -> Column:
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0.0))


def copies(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` of every document.

    Needs ``doc_id, source, text``; of other columns, a struct ``row`` is carried along.
    """
    spark = documents.sparkSession
    carried = [c for c in ("row",) if c in documents.columns]
    sized = documents.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), *carried)
    bin_of = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(BINS)).alias("bin")
    cells = stored(spark, sized.groupBy("source", "size", bin_of).agg(F.count("*").alias("n")), "mixing-sizes")
    sizes = cells.where("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(spark, source_targets(sources, weights, most), "mixing-targets")
    tilts = solve(spark, sizes, targets, most)

    # Cumulated fractions over the sizes of a source, then over the parts of a size.
    cell = _by_source(cells, tilts)
    rate = F.least(F.lit(float(most)), F.exp(F.col("lam") * F.col("size") / F.col("mean")))
    # A bound met but for rounding is the bound; without this its extras would scatter.
    rate = F.when(F.col("target") >= most * F.col("source_size"), F.lit(float(most))).otherwise(rate)
    rate = F.when((F.col("size") > 0) & (F.col("target") > 0), rate).when(F.col("size") > 0, 0.0).otherwise(1.0)
    cell = cell.withColumn("rate", rate).withColumn("whole", F.floor("rate")).withColumn("part", F.col("rate") - F.floor("rate"))
    # A source has as many rows here as sizes occur in it, a size as many as it has parts.
    fractions = F.col("n") * F.col("part")
    by_size = cell.groupBy("source", "size").agg(F.sum(fractions).alias("fraction"))
    by_size = by_size.withColumn("below", _sum_before("fraction", ["source"], "size"))
    below = by_size.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "below")
    same_size = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    cell = cell.join(below, same_size).withColumn("fraction", fractions)
    cell = cell.withColumn("before", F.col("below") + _sum_before("fraction", ["source", "size"], "bin") + 0.5)
    cell = cell.select(
        F.col("source").alias("c_source"), F.col("size").alias("c_size"), F.col("bin").alias("c_bin"), "source_size", "target", "whole", "part", "before"
    )
    placed = sized.withColumn("bin", bin_of)
    hit = placed["source"].eqNullSafe(cell["c_source"]) & (placed["size"] == cell["c_size"]) & (placed["bin"] == cell["c_bin"])
    joined = placed.join(cell, hit, "left")
    number = F.row_number().over(Window.partitionBy("source", "size", "bin").orderBy(F.xxhash64(F.lit(13), "doc_id"), "doc_id"))
    extra = F.floor(F.col("before") + F.col("k") * F.col("part")) - F.floor(F.col("before") + (F.col("k") - 1) * F.col("part"))
    # Every document has a cell; were one lost, that must not pass for a document left out.
    lost = F.raise_error(F.lit("a document without a rate")).cast("int")
    taken = F.when(F.col("c_size").isNull(), lost).otherwise(F.least(F.lit(most), F.col("whole") + extra).cast("int"))
    return joined.withColumn("k", number).select("doc_id", "source", "size", "source_size", "target", taken.alias("copies"), *carried)


def report(documents: DataFrame) -> DataFrame:
    """Words taken from every document, beside the size and target of its source."""
    return copies(documents).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(documents: DataFrame) -> DataFrame:
    """The documents as the mix takes them: each as often as it has copies."""
    packed = documents.select("doc_id", "source", "text", F.struct(*documents.columns).alias("row"))
    times = copies(packed).where("copies > 0")
    return times.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
