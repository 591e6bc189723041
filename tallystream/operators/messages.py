"""Envelope, encode, decode and the split into accepted and rejected messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.functions import json_codec
from tallystream.schema import FIELDS


def to_envelope(messages: DataFrame) -> DataFrame:
    """Key and value as strings; whatever else the source gives stays as it is."""
    rest = [c for c in messages.columns if c not in ("key", "value")]
    return messages.selectExpr("CAST(key AS STRING)", "CAST(value AS STRING)", *(f"`{c}`" for c in rest))


def raw_pairs(messages: DataFrame) -> DataFrame:
    return messages.select("key", "value")


def encode(records: DataFrame, fields: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
    """Records as messages with a JSON ``value``; columns not encoded are kept."""
    fields = list(fields or records.columns)
    rest = [c for c in records.columns if c not in fields and c != key]
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return records.select(key_column.alias("key"), json_codec.encode(*fields).alias("value"), *rest)


def decode(
    messages: DataFrame,
    required: Sequence[str] = FIELDS,
    on_bad: str = "quarantine",
    texts: Sequence[str] = (),
    kinds: bool = False,
) -> DataFrame:
    """Adds the user fields and ``reason``, NULL for a good message.

    ``on_bad="fail"`` ends the job at the first bad message instead of marking it.
    Fields of ``texts`` must be strings or null. ``kinds`` adds what JSON kind each field
    has, which tells ``5`` from ``"5"``.
    """
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(f"on_bad must be 'quarantine' or 'fail', not {on_bad!r}")
    unknown = [f for f in (*required, *texts) if f not in FIELDS]
    if unknown:
        raise ValueError(f"unknown fields: {unknown}")
    # explode keeps the parse in one place: a plain column would be copied into
    # every filter pushed below the projection, and the JSON parsed again there.
    parsed = messages.withColumn("_j", F.explode(F.array(json_codec.parse(F.col("value"), FIELDS))))
    kind_of = F.struct(*(json_codec.kind(F.col("_j"), f).alias(f) for f in FIELDS)).alias("kinds")
    decoded = parsed.select(
        *messages.columns,
        *(json_codec.text(F.col("_j"), f).alias(f) for f in FIELDS),
        *([kind_of] if kinds else []),
        json_codec.reject_reason(F.col("value"), F.col("_j"), required, texts).alias("reason"),
    )
    if on_bad == "fail":
        stop = F.raise_error(F.concat(F.lit("bad message, "), F.col("reason")))
        decoded = decoded.where(F.when(F.col("reason").isNull(), True).otherwise(stop.cast("boolean")))
    return decoded


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).drop("reason")


def rejected(decoded: DataFrame) -> DataFrame:
    keep = [c for c in decoded.columns if c not in (*FIELDS, "kinds")]
    return decoded.where(F.col("reason").isNotNull()).select(*keep)
