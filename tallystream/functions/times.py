"""Timestamps with and without time zone, the latter read as UTC whatever the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def ntz_to_instant(ts: Column) -> Column:
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts)
    return F.timestamp_micros(micros)


def instant_to_ntz(ts: Column) -> Column:
    micros = F.unix_micros(ts).cast("decimal(20,0)")
    seconds = (micros * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")
    return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
