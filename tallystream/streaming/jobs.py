"""The streaming jobs. Each takes a stream of messages and returns the running query."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallystream.operators import enrich, frozen, messages as msg, metrics
from tallystream.operators.networks import NetworkIndex
from tallystream.operators.ranges import RangeIndex, index_ranges
from tallystream.operators.windows import window_seconds
from tallystream.schema import FIELDS
from tallystream.streaming import commits, progress as progress_log, sinks, users
from tallystream.workspace import new_folder

KEYS = ("batch_id", "batch_time")

# The names of the result folders.
RAW, COUNTRY, USERS, GENDER, IP = "raw_data", "count_of_country", "unique_user", "gender_count", "ip_data"
QUARANTINE, LANDED = "quarantine", "raw_data_df"

# Streams switch adaptive execution off; a batch is a plain table and wants it for
# skewed joins and small shuffles. JSON texts seldom repeat, so trying to compress
# the kept batch takes time and saves little.
BATCH_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.inMemoryColumnarStorage.compressed": "false",
}


# The progress tables of running queries.
_LOGS: dict[str, progress_log.ProgressLog] = {}


def _start(
    writer: DataStreamWriter, name: str, checkpoint: str, seconds, available_now: bool, least: int = 1
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        # Where no window hangs on it, an interval of 0 means one batch after the other.
        wait = 0 if least == 0 and float(seconds) == 0 else window_seconds(seconds)
        writer = writer.trigger(processingTime=f"{wait} seconds")
    return writer.queryName(name).start()


def _start_logged(
    spark: SparkSession, log: str, writer: DataStreamWriter, name: str, checkpoint: str, seconds, available_now: bool,
    least: int = 1,
) -> StreamingQuery:
    """Starts a query whose batches are kept in a progress table."""
    progress_log.fill_gaps(spark, log, checkpoint)
    listener = progress_log.ProgressLog(spark, log, name)
    spark.streams.addListener(listener)
    try:
        query = _start(writer, name, checkpoint, seconds, available_now, least)
    except Exception:
        spark.streams.removeListener(listener)
        raise
    _LOGS[query.runId] = listener
    return query


def finish(query: StreamingQuery, seconds: float = 60) -> None:
    """Waits for the end of a query, and so many seconds for the last rows of its progress table."""
    listener = _LOGS.pop(query.runId, None)
    try:
        query.awaitTermination()
    finally:
        if listener is not None:
            listener.settle(seconds)


def _require(**names: str) -> None:
    missing = [k for k, v in names.items() if not v]
    if missing:
        raise ValueError(f"missing parameters: {', '.join(missing)}")


Located = Callable[[DataFrame], DataFrame]


def _results(decoded: DataFrame, base: DataFrame, located: Located | None) -> dict[str, Callable[[], DataFrame]]:
    """The outputs of one micro-batch by folder, each made when it is written: a lookup asks
    as soon as its output is made, and by then the batch should be kept."""
    good = msg.accepted(decoded)
    by_country = metrics.roll_up(base, KEYS, "country")
    total = metrics.roll_up(base, KEYS).select(*KEYS, F.lit("message_total").alias("label"), "n")
    results = {
        RAW: decoded.select(*KEYS, "key", "value"),
        COUNTRY: metrics.ranked(by_country, "country", KEYS),
        USERS: metrics.unique_users(good, KEYS).unionByName(total),
        GENDER: metrics.roll_up(base, KEYS, "gender"),
        QUARANTINE: msg.rejected(decoded).select(*KEYS, "key", "value", "reason"),
    }
    made = {name: lambda df=df: df for name, df in results.items()}
    if located is not None:
        made[IP] = lambda: enrich.ip_rows(located(good), KEYS)
    return made


# Batches between two rewritings of the kept answers of a lookup.
COMPACT_EVERY = 64


def _row_counts(decoded: DataFrame, base: DataFrame, results: Sequence[str]) -> tuple[dict[str, int], datetime | None]:
    """How many rows the results of a batch have, and its time, from what is kept of it."""
    seen = decoded.agg(F.count("*").alias("all"), F.count("reason").alias("bad"), F.max("batch_time").alias("at")).first()
    group = lambda c: F.count_distinct(F.struct(c)).alias(c)
    groups = base.agg(group("country"), group("gender")).first()
    good = seen["all"] - seen["bad"]
    counts = {
        RAW: seen["all"], COUNTRY: groups["country"], USERS: 2 if good else 0, GENDER: groups["gender"],
        QUARANTINE: seen["bad"], IP: good,
    }
    return {m: counts[m] for m in results}, seen["at"]


def _at_once(spark: SparkSession, write: Callable[[str], None], names: list[str]) -> None:
    """Runs the writes side by side: most are small and would leave the cluster idle.
    The first failure is raised after all have ended."""
    target = inheritable_thread_target(spark)(write)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        for done in [pool.submit(target, name) for name in names]:
            done.result()


def run_metrics(
    messages: DataFrame,
    out: str,
    topic: str,
    seconds=10,
    *,
    ranges: DataFrame | RangeIndex | NetworkIndex | None = None,
    lookup: enrich.Lookup | None = None,
    place_age: float | None = 86_400,
    required: Sequence[str] = FIELDS,
    on_bad: str = "quarantine",
    user_window: int | None = None,
    fmt: str = "parquet",
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Raw data, country, user, gender and IP results of every micro-batch.

    A batch is read and decoded once and kept for its outputs. ``batch_time`` is
    set before ``foreachBatch``, so a batch that is run again keeps its time. The batch
    is shown to readers (``commits.results``) when all of it is written.

    Places come from ``ranges``, which are indexed and written once at the start, or from
    ``lookup``, whose answers are kept for ``place_age`` seconds (None: asked for in every batch).
    With ``user_window``, the users of windows of so many seconds are kept over the
    batches too (``users.window_users``).
    """
    _require(out=out, topic=topic)
    if user_window is not None:
        user_window = window_seconds(user_window)
    if isinstance(ranges, DataFrame):
        ranges = index_ranges(ranges)
    places, located = None, None
    if ranges is not None:
        index = frozen.freeze(messages.sparkSession, ranges, f"{out.rstrip('/')}/{topic}/ip_index")
        located = lambda good: enrich.ip_enrich(good, index)
    elif lookup is not None and place_age is None:
        located = lambda good: enrich.lookup_enrich(good, lookup)
    elif lookup is not None:
        places = enrich.PlaceTable(f"{out.rstrip('/')}/{topic}/places", lookup, place_age)
        located = lambda good: places.enrich(good, datetime.now(timezone.utc))
    envelope = msg.to_envelope(messages)
    pairs = msg.raw_pairs(envelope) if user_window is None else envelope.select("key", "value", "timestamp")
    stamped = pairs.withColumn("batch_time", F.current_timestamp())

    place = commits.manifest_path(out, topic, "metrics", fmt)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        conf = spark.conf
        before = {k: conf.get(k) for k in BATCH_SETTINGS}
        for k, v in BATCH_SETTINGS.items():
            conf.set(k, v)
        query, started = spark.sparkContext.getLocalProperty(commits.QUERY_ID), datetime.now(timezone.utc)
        try:
            if not commits.is_whole(spark, place, batch_id, query):
                rows, batch_time = write_results(batch, batch_id)
                commits.commit(spark, place, batch_id, query, rows, batch_time, started, datetime.now(timezone.utc))
            if places is not None and (batch_id + 1) % COMPACT_EVERY == 0:
                places.compact(spark)
            if user_window is not None:
                users.merge_up(spark, out, topic, user_window, batch_id, query)
        finally:
            for k, v in before.items():
                conf.set(k, v)

    def write_results(batch: DataFrame, batch_id: int) -> tuple[dict[str, int], datetime | None]:
        spark = batch.sparkSession
        decoded = msg.decode(batch.withColumn("batch_id", F.lit(batch_id)), required, on_bad)
        decoded.persist(StorageLevel.MEMORY_AND_DISK)
        base = metrics.country_gender_base(msg.accepted(decoded), KEYS).persist()
        results = _results(decoded, base, located)

        def save(metric: str) -> None:
            if metric == users.RUNS:
                run = users.run_of_batch(msg.accepted(decoded), user_window)
                run.write.mode("overwrite").parquet(users.run_path(out, topic, user_window, 0, batch_id))
            else:
                sinks.write_batch(results[metric]().drop("batch_id"), out, topic, metric, batch_id, fmt)

        try:
            # The first write fills what is kept. Side by side on an empty store, each
            # write would read and decode for itself on the executors it lands on.
            save(RAW)
            rest = [name for name in results if name != RAW]
            _at_once(spark, save, rest + [users.RUNS] * (user_window is not None))
            rows, batch_time = _row_counts(decoded, base, list(results))
            if user_window is not None:
                rows[users.RUNS] = spark.read.parquet(users.run_path(out, topic, user_window, 0, batch_id)).count()
            return rows, batch_time
        finally:
            base.unpersist()
            decoded.unpersist()

    writer = stamped.writeStream.foreachBatch(write)
    state = checkpoint or sinks.checkpoint_path(out, topic, "metrics", fmt)
    return _start(writer, f"metrics-{topic}", state, seconds, available_now)


def run_landing(
    messages: DataFrame,
    out: str,
    topic: str,
    seconds=10,
    fmt: str = "parquet",
    *,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Lands key and value as they are. The checkpoint carries the format too, so a
    change of format starts anew."""
    _require(out=out, topic=topic, fmt=fmt)
    writer = sinks.landing_writer(msg.to_envelope(messages), fmt)
    writer = writer.option("path", sinks.result_path(out, topic, LANDED, fmt))
    state = checkpoint or sinks.checkpoint_path(out, topic, "landing", fmt)
    log = progress_log.progress_path(out, topic, "landing", fmt)
    return _start_logged(messages.sparkSession, log, writer, f"landing-{topic}-{fmt}", state, seconds, available_now)


def run_print(
    messages: DataFrame,
    topic: str,
    seconds=10,
    *,
    rows: int = 1000,
    out: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Prints the decoded messages: with ``out`` all of them, as JSON lines written by the
    executors; without, the first ``rows`` of a batch on the console, for a look."""
    decoded = msg.decode(msg.to_envelope(messages), required=())
    shown = decoded.select("value", *FIELDS, "reason")
    place = checkpoint or new_folder(messages.sparkSession, f"print-{topic}")
    if out is not None:
        lines = sinks.as_text(shown).writeStream.format("text").outputMode("append").option("path", out)
        log = f"{place.rstrip('/')}-progress"
        return _start_logged(messages.sparkSession, log, lines, f"print-{topic}", place, seconds, available_now)
    return _start(sinks.console_writer(shown, rows), f"print-{topic}", place, seconds, available_now)


def run_publish(
    messages: DataFrame, broker: str, topic: str, seconds=10, *, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Replays message files into a topic. With ``max_files`` on the file source the
    trigger interval sets the pace; 0 sends without waiting. The progress table lies
    beside the checkpoint."""
    writer = sinks.publish_writer(msg.to_envelope(messages), broker, topic)
    log = f"{checkpoint.rstrip('/')}-progress"
    return _start_logged(
        messages.sparkSession, log, writer, f"publish-{topic}", checkpoint, seconds, available_now, least=0
    )


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Rows and time of the recent micro-batches of a running query, of which Spark keeps a
    bounded number. All batches are in ``commits.progress`` and ``progress.batches``."""
    rows = [
        (p["batchId"], p["timestamp"], p["numInputRows"], p["durationMs"].get("triggerExecution"))
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, "batch_id long, started string, input_rows long, millis long")
