"""Small helpers of the operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tallystream.llm.common import SMALL_BATCHES, bounded_sample, restart_point
from tallystream.workspace import settings


def test_sample_is_bounded_whatever_the_ids(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    for doc_id in (F.col("doc_id"), F.lit(None).cast("bigint"), F.lit(5).cast("bigint"), F.col("doc_id") % 3):
        some = bounded_sample(rows.withColumn("doc_id", doc_id), "doc_id", 1000)
        assert 500 <= some.count() <= 2000
        assert some.exceptAll(bounded_sample(rows.withColumn("doc_id", doc_id), "doc_id", 1000)).count() == 0
    assert bounded_sample(rows, "doc_id", 30_000).count() == 20_000
    copies = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit("t").alias("text"))
    assert bounded_sample(copies, "doc_id", 1000).count() <= 2000


def test_loops_do_not_multiply_sizes(spark):
    """After many rounds of joins the size that Spark expects is that of the table."""
    state = spark.range(10).withColumnRenamed("id", "a")
    for _ in range(6):
        state = restart_point(spark, state.join(state.groupBy("a").count().select("a"), "a"))
    size = state._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 1 << 20 and state.count() == 10


def test_batches_are_small_in_bytes(spark):
    """Long texts come to a worker a few at a time, one that is larger than a batch by itself."""

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"rows": [len(batch)], "most": [batch["text"].str.len().max()], "bytes": [batch["text"].str.len().sum()]})

    long = F.when(F.col("id") == 70, 3_000_000).otherwise(20_000).cast("int")
    rows = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), long).alias("text"))
    with settings(spark, SMALL_BATCHES):
        found = rows.mapInPandas(sizes, "rows long, most long, bytes long").collect()
    assert sum(r["rows"] for r in found) == 300
    assert all(r["bytes"] - r["most"] <= 1 << 20 for r in found)
