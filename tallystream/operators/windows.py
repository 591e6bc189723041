"""Fixed windows on arrival time and the arrival schedule of a replay."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def window_seconds(seconds) -> int:
    """A window length given as number or text; whole and positive."""
    try:
        n = int(seconds)
    except (TypeError, ValueError):
        raise ValueError(f"window length must be whole seconds, not {seconds!r}") from None
    if n <= 0:
        raise ValueError(f"window length must be positive, not {n}")
    return n


def assign_window(df: DataFrame, ts: str, seconds) -> DataFrame:
    """Adds ``window_start``. Every row is in exactly one window; rows without an arrival
    time share the window NULL, so counts over all windows add up to all rows.

    ``F.window`` would drop those rows. On a stream it is used all the same, because
    only it carries a watermark on.
    """
    length = window_seconds(seconds)
    if df.isStreaming:
        return df.withColumn("window_start", F.window(ts, f"{length} seconds")["start"])
    kind = df.schema[ts].dataType
    since = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    micros = since if isinstance(kind, T.TimestampNTZType) else F.unix_micros(ts)
    past = F.pmod(micros, F.lit(length * 1_000_000)).cast("decimal(18,0)")
    wait = (past * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")
    return df.withColumn("window_start", F.col(ts) - F.make_dt_interval(secs=wait))


def arrival_schedule(df: DataFrame, ordinal: str, start: datetime, seconds: float) -> DataFrame:
    """Adds ``arrival_ts``: message *i* arrives ``i * seconds`` after ``start``."""
    if seconds < 0:
        raise ValueError("seconds between messages must not be negative")
    wait = F.col(ordinal).cast("decimal(18,0)") * F.lit(str(seconds)).cast("decimal(18,6)")
    begin = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumn("arrival_ts", begin + F.make_dt_interval(secs=wait.cast("decimal(18,6)")))
