"""Per-window results. Every function maps decoded, accepted rows to a small table.

``keys`` are the columns that identify a window: ``window_start`` in a backfill,
``batch_id`` and ``batch_time`` inside a micro-batch. NULL is a group of its own
and a window without rows gives no row. All counts combine map-side, so a group
that holds a large part of all rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystream.operators.ordering import with_ordinal

BY_WINDOW = ("window_start",)


def _count_by(df: DataFrame, keys: Sequence[str], *group: str) -> DataFrame:
    return df.groupBy(*keys, *group).agg(F.count("*").alias("n"))


def country_count(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    return _count_by(df, keys, "country")


def gender_count(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    return _count_by(df, keys, "gender")


def email_count(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    return _count_by(df, keys, "email")


def ranked(counts: DataFrame, by: str, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    """Largest count first inside each window, with the place as ``rk``.

    The window function sees one row per window and distinct value of ``by``,
    not the messages.
    """
    order = [F.desc("n"), F.asc_nulls_last(by)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    return counts.withColumn("rk", place)


def ranked_wide(counts: DataFrame, by: str, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    """``ranked`` for groups too many for one task, such as the users of a window.

    All rows are sorted once by range partitions, windows one after the other; a place is
    the distance from the first row of the window. No task holds a window.
    """
    order = [*(F.asc_nulls_first(k) for k in keys), F.desc("n"), F.asc_nulls_last(by)]
    placed = with_ordinal(counts, *order, name="_at")
    if not keys:
        return placed.select(*counts.columns, (F.col("_at") + 1).alias("rk"))
    firsts = placed.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min("_at").alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return placed.join(firsts, same).select(*counts.columns, (F.col("_at") - F.col("_first") + 1).alias("rk"))


def email_rank(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    return ranked_wide(email_count(df, keys), "email", keys)


def country_rank(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    return ranked(country_count(df, keys), "country", keys)


def message_total(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    """All messages of a window, NULL e-mail included. Adding up the counts per
    e-mail gives the same number; counting directly saves that shuffle."""
    return _count_by(df, keys).select(*keys, F.lit("message_total").alias("label"), "n")


def unique_users(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    """Distinct e-mails of a window; NULL is no user."""
    users = df.groupBy(*keys).agg(F.count_distinct("email").alias("n"))
    return users.select(*keys, F.lit("unique_users").alias("label"), "n")


def country_gender_base(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    """Counts per country and gender; the coarser counts are sums over these rows."""
    return _count_by(df, keys, "country", "gender")


def roll_up(base: DataFrame, keys: Sequence[str], *group: str) -> DataFrame:
    return base.groupBy(*keys, *group).agg(F.sum("n").alias("n"))


def all_metrics(df: DataFrame, keys: Sequence[str] = BY_WINDOW) -> DataFrame:
    """Country, gender and total counts in one pass over the messages.

    The grouping sets expand the pre-aggregated rows, not the messages.
    """
    base = country_gender_base(df, keys)
    k = list(keys)
    sets = base.groupingSets(
        [[*k, "country"], [*k, "gender"], k], *k, "country", "gender"
    ).agg(
        F.sum("n").alias("n"),
        F.grouping("country").alias("no_country"),
        F.grouping("gender").alias("no_gender"),
    )
    by_country, by_gender = F.col("no_country") == 0, F.col("no_gender") == 0
    return sets.select(
        *keys,
        F.when(by_country, "country").when(by_gender, "gender").otherwise("message_total").alias("metric"),
        F.when(by_country, F.col("country")).when(by_gender, F.col("gender")).alias("group_value"),
        "n",
    )


def chained_unique_users(df: DataFrame, ts: str, seconds: int, delay: str) -> DataFrame:
    """Distinct e-mails per window on a stream, where ``count_distinct`` is refused.

    State is one row per window and e-mail until the watermark passes the window.
    """
    per_user = (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, f"{seconds} seconds").alias("w"), "email")
        .agg(F.count("*").alias("n"))
    )
    return (
        per_user.groupBy("w")
        .agg(F.count("email").alias("unique_users"), F.sum("n").alias("message_total"))
        .select(F.col("w.start").alias("window_start"), "unique_users", "message_total")
    )
