"""Every registered query, over the whole tables of a directory."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystream.functions.times import instant_to_ntz
from tallystream.operators import enrich, messages as msg, metrics
from tallystream.operators.ordering import with_ordinal
from tallystream.operators.networks import MAX_BROADCAST_BYTES, index_networks
from tallystream.operators.ranges import RangeIndex, index_ranges
from tallystream.operators.windows import arrival_schedule, assign_window
from tallystream.plans import inputs
from tallystream.schema import FIELDS, GEO_FIELDS
from tallystream.sources import files
from tallystream.streaming import commits, jobs, progress, sinks, users
from tallystream.workspace import new_folder, settings, stored

Query = Callable[[SparkSession, str], DataFrame]

DAY = 86_400
REPLAY_START = datetime(2024, 1, 1)
REPLAY_SECONDS = 2
REPLAY_WINDOW = 10

PARTS = 4

# The messages of a micro-batch are kept for its outputs, so their size is bounded.
MAX_BYTES = 100 * 1024**3


def _ids(df: DataFrame) -> DataFrame:
    """Event id and time from the envelope, beside the user fields."""
    return df.select(
        F.col("key").cast("bigint").alias("event_id"), F.col("timestamp").alias("ts"), *FIELDS
    )


def _windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_window(inputs.decoded_users(spark, sf_dir), "timestamp", DAY)


# Sources, projections, encode and decode

def raw_messages(spark, sf_dir):
    return msg.raw_pairs(msg.to_envelope(inputs.topic_messages(spark, sf_dir)))


def cast_key_value(spark, sf_dir):
    return msg.to_envelope(inputs.topic_messages(spark, sf_dir))


def decoded_records(spark, sf_dir):
    return _ids(inputs.decoded_users(spark, sf_dir))


def json_roundtrip(spark, sf_dir):
    decoded = inputs.decoded_users(spark, sf_dir)
    return msg.encode(decoded.select("key", *FIELDS), FIELDS, key="key")


def json_file_scan(spark, sf_dir):
    path = new_folder(spark, "json-lines")
    records = inputs.user_records(spark, sf_dir).select("event_id", *FIELDS)
    msg.encode(records).select("value").write.text(path)
    lines = msg.accepted(msg.decode(files.json_lines(spark, path)))
    event_id = F.get_json_object("value", "$.event_id").cast("bigint")
    return lines.select(event_id.alias("event_id"), *FIELDS)


def json_array_scan(spark, sf_dir):
    """Arrays of at most a thousand consecutive records, one per line."""
    records = inputs.user_records(spark, sf_dir).select("event_id", *FIELDS)
    arrays = (
        records.groupBy(F.expr("event_id div 1000").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("event_id", *FIELDS))).alias("items"))
        .select("block", F.to_json("items", {"ignoreNullFields": "false"}).alias("value"))
    )
    items = msg.accepted(msg.decode(files.array_elements(arrays)))
    return items.select("block", F.col("position").cast("bigint").alias("position"), *FIELDS)


def json_array_file_scan(spark, sf_dir):
    """Files of one array each (at most 100,000 records), read in splits: the files are divided
    between the tasks wherever that falls, up to Spark's usual size of a split."""
    path = new_folder(spark, "json-array-files")
    records = inputs.user_records(spark, sf_dir).select("event_id", *FIELDS)
    arrays = records.groupBy(F.expr("event_id div 100000").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("event_id", *FIELDS))).alias("items")
    )
    text = F.to_json("items", {"ignoreNullFields": "false"}).alias("value")
    arrays.select(text).write.option("maxRecordsPerFile", 1).text(path)
    with settings(spark, {"spark.sql.files.openCostInBytes": "1k"}):
        elements = stored(spark, files.json_array_split(spark, path), "json-array-elements")
    event_id = F.get_json_object("value", "$.event_id").cast("bigint")
    items = msg.accepted(msg.decode(elements)).select("file", "block", "line", event_id.alias("event_id"), *FIELDS)
    place = F.row_number().over(Window.partitionBy("file").orderBy("block", "line")) - 1
    return items.select("event_id", place.cast("bigint").alias("position"), *FIELDS)


def country_kinds(spark, sf_dir):
    """Countries by the kind of JSON value they stand as: ``5`` and ``"5"`` are two groups."""
    decoded = msg.decode(msg.to_envelope(inputs.mixed_messages(spark, sf_dir)), required=(), kinds=True)
    good = msg.accepted(decoded)
    return good.groupBy(F.col("kinds.country").alias("kind"), "country").agg(F.count("*").alias("n"))


def strict_texts(spark, sf_dir):
    """What decoding rejects where all fields must be texts."""
    decoded = msg.decode(msg.to_envelope(inputs.mixed_messages(spark, sf_dir)), texts=FIELDS)
    return decoded.groupBy("reason").agg(F.count("*").alias("n"))


# Metrics

def country_count(spark, sf_dir):
    return metrics.country_count(_windowed(spark, sf_dir))


def country_rank(spark, sf_dir):
    return metrics.country_rank(_windowed(spark, sf_dir))


def email_count(spark, sf_dir):
    return metrics.email_count(_windowed(spark, sf_dir))


def email_rank(spark, sf_dir):
    return metrics.email_rank(_windowed(spark, sf_dir))


def email_rank_overall(spark, sf_dir):
    """All users in one window, ranked without a task that holds it."""
    return metrics.email_rank(inputs.decoded_users(spark, sf_dir), ())


def gender_count(spark, sf_dir):
    return metrics.gender_count(_windowed(spark, sf_dir))


def message_total(spark, sf_dir):
    return metrics.message_total(_windowed(spark, sf_dir))


def unique_users(spark, sf_dir):
    return metrics.unique_users(_windowed(spark, sf_dir))


def all_metrics(spark, sf_dir):
    return metrics.all_metrics(_windowed(spark, sf_dir))


# Rejected messages

def quarantine(spark, sf_dir):
    decoded = msg.decode(msg.to_envelope(inputs.flawed_messages(spark, sf_dir)))
    bad = msg.rejected(decoded)
    return bad.select(F.col("key").cast("bigint").alias("event_id"), "value", "reason")


# Enrichment

def _flat_geo(enriched: DataFrame, fields: Sequence[str] = GEO_FIELDS) -> DataFrame:
    geo = (F.col("geo")[f].alias(f"geo_{f}") for f in fields)
    return enriched.select(F.col("key").cast("bigint").alias("event_id"), "email", "ip_address", *geo)


def ip_enrich(spark, sf_dir):
    users = inputs.decoded_users(spark, sf_dir)
    return _flat_geo(enrich.ip_enrich(users, index_ranges(inputs.ip_ranges(spark, sf_dir))))


def ip_enrich_sorted(spark, sf_dir):
    """The form for range tables too large to broadcast, on the same ranges."""
    users = inputs.decoded_users(spark, sf_dir)
    return _flat_geo(enrich.ip_enrich(users, RangeIndex(inputs.ip_ranges(spark, sf_dir))))


def lookup_enrich(spark, sf_dir):
    """A lookup without a service: names the network and the host of an address."""

    def parts_of(addresses: pd.Series) -> pd.DataFrame:
        octets = addresses.str.split(".")
        return pd.DataFrame({"hostname": "net-" + octets.str[0], "city": "host-" + octets.str[3]})

    users = inputs.decoded_users(spark, sf_dir)
    return _flat_geo(enrich.lookup_enrich(users, parts_of), ("hostname", "city"))


def _networks(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    messages = msg.accepted(msg.decode(msg.to_envelope(inputs.dual_stack_messages(spark, sf_dir))))
    index = index_networks(inputs.ip_networks(spark, sf_dir), limit)
    return _flat_geo(enrich.ip_enrich(messages, index), ("city", "country"))


def ip_networks(spark, sf_dir):
    """Addresses of both families in networks of several lengths."""
    return _networks(spark, sf_dir, MAX_BROADCAST_BYTES)


def ip_networks_shuffled(spark, sf_dir):
    """The form for network tables too large to broadcast, on the same networks."""
    return _networks(spark, sf_dir, 0)


def lookup_batches(spark, sf_dir):
    """Messages and answers per address over four starts of the job, and how often it was asked for."""

    def network_of(addresses: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"hostname": "net-" + addresses.str.split(".").str[0]})

    out, topic = new_folder(spark, "lookup-out"), "users"
    _in_parts(spark, sf_dir, "lookup", lambda s: jobs.run_metrics(s, out, topic, lookup=network_of, available_now=True))
    found = commits.results(spark, out, topic, jobs.IP)
    rows = found.groupBy("ip_address", F.col("geo.hostname").alias("hostname")).agg(F.count("*").alias("n"))
    asked = spark.read.schema(enrich.PLACE).parquet(f"{out}/{topic}/places/places/0")
    asked = asked.groupBy("ip_address").agg(F.count("*").alias("asked"))
    return rows.join(asked, "ip_address", "left")


# Replay

def _scheduled(df: DataFrame, ordinal: str) -> DataFrame:
    return arrival_schedule(df, ordinal, REPLAY_START, REPLAY_SECONDS)


def replay_schedule(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select("event_id")
    return _scheduled(events, "event_id")


def replay_ordinal(spark, sf_dir):
    """Numbers taken from the order of time, where the records carry none."""
    events = inputs.table(spark, sf_dir, "events").select("event_id", "ts")
    return _scheduled(with_ordinal(events, "ts", "event_id"), "ordinal")


def replay_windows(spark, sf_dir):
    arrivals = assign_window(replay_schedule(spark, sf_dir), "arrival_ts", REPLAY_WINDOW)
    return arrivals.groupBy("window_start").agg(F.count("*").alias("n"))


# Streams. The messages are written once as files, which stand for the topic.

def _topic_stream(
    spark: SparkSession, messages: DataFrame, name: str, max_bytes: int | None = MAX_BYTES
) -> DataFrame:
    path = new_folder(spark, f"{name}-topic")
    inputs.write_topic_files(messages, path)
    return files.file_stream(spark, path, fmt="parquet", max_bytes=max_bytes)


def microbatch_metrics(spark, sf_dir):
    """All outputs of the metrics job, added up over its micro-batches."""
    stream = _topic_stream(spark, inputs.flawed_messages(spark, sf_dir), "metrics")
    out, topic = new_folder(spark, "metrics-out"), "users"
    jobs.run_metrics(
        stream, out, topic, ranges=inputs.ip_ranges(spark, sf_dir), available_now=True
    ).awaitTermination()

    def totals(metric: str, group, n=F.count("*")) -> DataFrame:
        rows = spark.read.parquet(sinks.result_path(out, topic, metric))
        return rows.groupBy(group.alias("group_value")).agg(n.cast("bigint").alias("n")).select(
            F.lit(metric).alias("metric"), "group_value", "n"
        )

    none = F.lit(None).cast("string")
    labels = spark.read.parquet(sinks.result_path(out, topic, jobs.USERS))
    everyone = labels.where("label = 'message_total'").select(
        F.lit(jobs.USERS).alias("metric"), F.col("label").alias("group_value"), "n"
    ).groupBy("metric", "group_value").agg(F.sum("n").alias("n"))
    return (
        totals(jobs.RAW, none)
        .unionByName(totals(jobs.COUNTRY, F.col("country"), F.sum("n")))
        .unionByName(totals(jobs.GENDER, F.col("gender"), F.sum("n")))
        .unionByName(totals(jobs.IP, F.col("geo.country")))
        .unionByName(totals(jobs.QUARANTINE, F.col("reason")))
        .unionByName(everyone)
    )


def _in_parts(spark: SparkSession, sf_dir: str, name: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Runs a job on a quarter of the messages, starts it anew when the next has come, and so on."""
    path = new_folder(spark, f"{name}-topic")
    messages = inputs.flawed_messages(spark, sf_dir)
    for part in range(PARTS):
        chosen = messages.where(F.col("key").cast("string").cast("bigint") % PARTS == part)
        inputs.write_topic_files(chosen, f"{path}/part-{part}")
        stream = files.file_stream(spark, f"{path}/*", fmt="parquet", max_bytes=MAX_BYTES)
        jobs.finish(start(stream))


def batch_commits(spark, sf_dir):
    """The rows of every result by part of the input, as the manifests of the batches say and
    as readers of whole batches find them. A part within the bound of a batch is one batch."""
    out, topic = new_folder(spark, "commits-out"), "users"
    ranges = index_ranges(inputs.ip_ranges(spark, sf_dir))
    _in_parts(spark, sf_dir, "commits", lambda s: jobs.run_metrics(s, out, topic, ranges=ranges, available_now=True))
    raw = commits.results(spark, out, topic, jobs.RAW)
    part_of = raw.groupBy("batch_id").agg(F.min(F.col("key").cast("bigint") % PARTS).alias("part"))
    listed = commits.manifest(spark, out, topic).where("batch_time IS NOT NULL").select("batch_id", "metric", "rows")
    found = None
    for metric in (jobs.RAW, jobs.COUNTRY, jobs.USERS, jobs.GENDER, jobs.IP, jobs.QUARANTINE):
        rows = commits.results(spark, out, topic, metric).groupBy("batch_id").agg(F.count("*").alias("found"))
        rows = rows.withColumn("metric", F.lit(metric))
        found = rows if found is None else found.unionByName(rows)
    met = listed.join(found, ["batch_id", "metric"], "full").join(part_of, "batch_id", "left")
    return met.groupBy("part", "metric").agg(F.sum("rows").alias("listed"), F.sum("found").alias("found"))


def batch_progress(spark, sf_dir):
    """The progress tables of two jobs over four starts: all messages, no batch twice, none missing."""
    out, topic = new_folder(spark, "progress-out"), "users"
    _in_parts(spark, sf_dir, "progress", lambda s: jobs.run_landing(s, out, topic, available_now=True))
    _in_parts(spark, sf_dir, "progress", lambda s: jobs.run_metrics(s, out, topic, available_now=True))

    def summary(job: str, batches: DataFrame) -> DataFrame:
        last, known = F.max("batch_id"), F.count_distinct("batch_id")
        return batches.where("millis IS NOT NULL AND started IS NOT NULL").agg(
            F.lit(job).alias("job"), F.sum("input_rows").alias("input_rows"),
            (F.count("*") - known).alias("repeated"), (last + 1 - known).alias("missing"),
        )

    landing = summary("landing", progress.batches(spark, out, topic, "landing"))
    return landing.unionByName(summary("metrics", commits.progress(spark, out, topic)))


def window_users(spark, sf_dir):
    """Distinct users per day, where every day lies in all batches of four starts."""
    out, topic = new_folder(spark, "window-users-out"), "users"
    _in_parts(spark, sf_dir, "window-users", lambda s: jobs.run_metrics(s, out, topic, user_window=DAY, available_now=True))
    found = users.window_users(spark, out, topic, DAY)
    return found.withColumn("window_start", instant_to_ntz(F.col("window_start")))


def _land(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    messages = inputs.topic_messages(spark, sf_dir)
    if fmt == sinks.LINES:  # a message with line breaks comes back as one
        broken = F.replace(F.col("value").cast("string"), F.lit(","), F.lit(",\n"))
        messages = messages.withColumn("value", broken.cast("binary"))
    stream = _topic_stream(spark, messages, f"landing-{fmt}")
    out, topic = new_folder(spark, f"landing-{fmt}-out"), "users"
    jobs.run_landing(stream, out, topic, fmt=fmt, available_now=True).awaitTermination()
    path = sinks.result_path(out, topic, jobs.LANDED, fmt)
    if fmt == sinks.LINES:
        return sinks.read_lines(spark, path)
    if fmt == "text":
        return spark.read.text(path).select("value")
    reader = spark.read.schema("key string, value string").format(fmt)
    if fmt == "csv":
        reader = reader.options(**sinks.CSV_OPTIONS)
    return reader.load(path)


def _landing(fmt: str) -> Query:
    return lambda spark, sf_dir: _land(spark, sf_dir, fmt)


def chained_unique_users(spark, sf_dir):
    """Distinct users as a stream. A closing message after the last day moves the
    watermark past it; its own window stays open and is no part of the result.

    The files are in no order of time, so one trigger takes them all: between
    triggers the watermark would shut out the messages of earlier days.
    """
    messages = inputs.topic_messages(spark, sf_dir).unionByName(inputs.closing_message(spark, sf_dir))
    stream = _topic_stream(spark, messages, "unique", max_bytes=None)
    good = msg.accepted(msg.decode(stream))
    out = new_folder(spark, "unique-out")
    result = metrics.chained_unique_users(good, "timestamp", DAY, "0 seconds")
    query = (
        result.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", new_folder(spark, "unique-checkpoint"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out).withColumn("window_start", instant_to_ntz(F.col("window_start")))


QUERIES: dict[str, Query] = {
    "raw_messages": raw_messages,
    "cast_key_value": cast_key_value,
    "decoded_records": decoded_records,
    "json_roundtrip": json_roundtrip,
    "json_file_scan": json_file_scan,
    "json_array_scan": json_array_scan,
    "json_array_file_scan": json_array_file_scan,
    "country_kinds": country_kinds,
    "strict_texts": strict_texts,
    "country_count": country_count,
    "country_rank": country_rank,
    "email_count": email_count,
    "email_rank": email_rank,
    "email_rank_overall": email_rank_overall,
    "gender_count": gender_count,
    "message_total": message_total,
    "unique_users": unique_users,
    "all_metrics": all_metrics,
    "quarantine": quarantine,
    "ip_enrich": ip_enrich,
    "ip_enrich_sorted": ip_enrich_sorted,
    "ip_networks": ip_networks,
    "ip_networks_shuffled": ip_networks_shuffled,
    "lookup_enrich": lookup_enrich,
    "lookup_batches": lookup_batches,
    "replay_schedule": replay_schedule,
    "replay_ordinal": replay_ordinal,
    "replay_windows": replay_windows,
    "microbatch_metrics": microbatch_metrics,
    "batch_commits": batch_commits,
    "batch_progress": batch_progress,
    "window_users": window_users,
    "raw_landing": _landing("parquet"),
    "raw_landing_csv": _landing("csv"),
    "raw_landing_json": _landing("json"),
    "raw_landing_orc": _landing("orc"),
    "raw_landing_text": _landing("text"),
    "raw_landing_lines": _landing("lines"),
    "chained_unique_users": chained_unique_users,
}
