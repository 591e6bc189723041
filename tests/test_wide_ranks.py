"""Ranks of windows that are spread over many tasks."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallystream.operators import metrics
from tallystream.workspace import settings


def plain(rows):
    out, groups = {}, {}
    for w, name, n in rows:
        groups.setdefault(w, []).append((name, n))
    for w, items in groups.items():
        items.sort(key=lambda x: (-x[1], x[0] is None, (x[0] or "").encode()))
        out |= {(w, name): i + 1 for i, (name, _) in enumerate(items)}
    return out


def test_ranks_match_sorting(spark):
    rng = random.Random(6)
    rows = [(w, f"u{rng.randrange(10**6)}", rng.randint(1, 9)) for w in (1, 2, None) for _ in range(900)]
    rows = list({(w, name): (w, name, n) for w, name, n in rows}.values()) + [(1, None, 5), (3, None, 1)]
    df = spark.createDataFrame(rows, "window_start int, email string, n bigint")
    got = {(r["window_start"], r["email"]): r["rk"] for r in metrics.ranked_wide(df, "email").collect()}
    assert got == plain(rows)
    both = metrics.ranked(df, "email").exceptAll(metrics.ranked_wide(df, "email"))
    assert both.count() == 0


def test_one_window_is_many_tasks(spark):
    """Ranks of a single window are given in several partitions, none by a window over it."""
    df = spark.range(20_000).select(F.col("id").cast("string").alias("email"), (F.col("id") % 97).alias("n"))
    # Small partitions would be put together, which is right and hides the split.
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        ranked = metrics.ranked_wide(df.withColumn("window_start", F.lit(1)), "email")
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 10_000
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(window_start" not in plan
    assert ranked.agg(F.max("rk"), F.count_distinct("rk")).first() == (20_000, 20_000)


def test_empty(spark):
    df = spark.createDataFrame([], "window_start int, email string, n bigint")
    assert metrics.ranked_wide(df, "email").collect() == []
    assert metrics.ranked_wide(df.drop("window_start"), "email", ()).columns == ["email", "n", "rk"]
