"""Writers: idempotent per-batch files, raw landing, console and topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallystream.sources import kafka

# JSON text is full of quotes and backslashes, so quotes are doubled instead of
# escaped; and spaces at the ends are part of a message. NULL has a sign of its own, so
# an empty message stays one. Messages may have line breaks, so a reader takes a file as
# a whole: for large data another format is the better one.
CSV_OPTIONS = {
    "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\x01", "multiLine": "true", "lineSep": "\n",
}


# Text with one message a line, whatever it holds: backslash and line breaks escaped, NULL as \\N.
LINES = "lines"


def as_line(value: Column) -> Column:
    """A message as one line."""
    escaped = F.replace(F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.coalesce(escaped, F.lit("\\N"))


def from_line(line: Column) -> Column:
    """The message of a line. What follows a double backslash is text: the pieces between
    them are unescaped one by one."""
    plain = lambda piece: F.replace(F.replace(piece, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    pieces = F.transform(F.split(line, r"\\\\", -1), plain)
    return F.when(line != "\\N", F.array_join(pieces, "\\"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The messages of files landed as ``lines``."""
    return spark.read.option("lineSep", "\n").text(path).select(from_line(F.col("value")).alias("value"))


def result_path(out: str, topic: str, metric: str, fmt: str = "parquet") -> str:
    """Formats have folders of their own, so no folder ever mixes them."""
    return f"{out.rstrip('/')}/{topic}/{metric}/{fmt}"


def checkpoint_path(out: str, topic: str, job: str, fmt: str) -> str:
    return f"{out.rstrip('/')}/{topic}/checkpoints/{job}-{fmt}"


def as_text(df: DataFrame) -> DataFrame:
    """A row as one JSON object per line, NULL written out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def flat(df: DataFrame) -> DataFrame:
    """Struct fields as columns of their own, for formats that know no structs."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            columns += [F.col(field.name)[n].alias(f"{field.name}_{n}") for n in field.dataType.names]
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


def write_batch(
    df: DataFrame, out: str, topic: str, metric: str, batch_id: int, fmt: str = "parquet"
) -> None:
    """One folder per metric and batch. A batch that runs again overwrites its own."""
    rows = {"text": as_text, "csv": flat}.get(fmt, lambda x: x)(df)
    writer = rows.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(f"{result_path(out, topic, metric, fmt)}/batch_id={batch_id}")


def landing_writer(messages: DataFrame, fmt: str) -> DataStreamWriter:
    """Key and value in the chosen format. ``text`` and ``lines`` have one column, so the value alone."""
    if fmt == LINES:
        rows = messages.select(as_line(F.col("value")).alias("value"))
        return rows.writeStream.format("text").option("lineSep", "\n").outputMode("append")
    rows = messages.select("value") if fmt == "text" else messages.select("key", "value")
    writer = rows.writeStream.format(fmt).outputMode("append")
    return writer.options(**CSV_OPTIONS) if fmt == "csv" else writer


def console_writer(messages: DataFrame, rows: int) -> DataStreamWriter:
    """Shows the first ``rows`` of every micro-batch; they pass through the driver."""
    writer = messages.writeStream.format("console").outputMode("append")
    return writer.options(truncate="false", numRows=rows)


def publish(messages: DataFrame, broker: str, topic: str) -> None:
    """Sends a batch of messages to a topic."""
    messages.select("key", "value").write.format("kafka").options(
        **kafka.write_options(broker, topic)
    ).save()


def publish_writer(messages: DataFrame, broker: str, topic: str) -> DataStreamWriter:
    return messages.select("key", "value").writeStream.format("kafka").options(
        **kafka.write_options(broker, topic)
    )
