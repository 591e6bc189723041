"""Declared schemas shared by the batch and the streaming form."""

from __future__ import annotations

from pyspark.sql import types as T

# The four fields every message carries.
FIELDS = ("email", "gender", "country", "ip_address")

# The fields of an IP place record.
GEO_FIELDS = ("hostname", "city", "region", "country", "loc", "postal", "timezone")


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


USER_SCHEMA = _strings(FIELDS)
GEO_STRUCT = _strings(GEO_FIELDS)

# A message as it lies in a file; a Kafka source adds topic, partition and offset.
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

# A line of a message file that is no envelope, as a column Spark fills.
BROKEN_LINE = "_broken_line"

RANGE_SCHEMA = T.StructType([
    T.StructField("lo", T.LongType(), False),
    T.StructField("hi", T.LongType(), False),
    T.StructField("geo", GEO_STRUCT),
])

# Networks as ``address/length``, of both families.
NETWORK_SCHEMA = T.StructType([T.StructField("network", T.StringType()), T.StructField("geo", GEO_STRUCT)])
