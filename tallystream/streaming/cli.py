"""Command line of the jobs, for spark-submit."""

from __future__ import annotations

import argparse
import importlib
import logging
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallystream.operators.enrich import Lookup
from tallystream.operators.networks import index_networks
from tallystream.schema import NETWORK_SCHEMA, RANGE_SCHEMA
from tallystream.sources import files
from tallystream.sources.kafka import kafka_stream
from tallystream.streaming import jobs, replay, sinks

log = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="run_job.py", description="Streaming jobs over JSON user records")
    p.add_argument("job", choices=["metrics", "landing", "print", "publish", "send", "replay"])
    p.add_argument("--topic", required=True)
    p.add_argument("--broker", help="host:port of the topic")
    p.add_argument("--files", help="folder of message files in place of a topic; the input of publish, send and replay")
    p.add_argument("--files-format", default="json", help="format of message files")
    p.add_argument(
        "--records", default="array", choices=sorted(files.RECORD_FILES), help="layout of the files to send"
    )
    p.add_argument("--pace", type=float, default=1, help="seconds from one message of replay to the next")
    p.add_argument("--window-seconds", default="10", help="length of a micro-batch window")
    p.add_argument("--out", help="folder of the results")
    p.add_argument("--format", default="parquet", help="format of the results")
    p.add_argument("--checkpoint", help="folder of the query state (default: below --out)")
    p.add_argument("--ranges", help="parquet table of IP ranges (lo, hi, geo)")
    p.add_argument("--lookup", help="module:function that gives place fields for a series of addresses")
    p.add_argument("--networks", help="parquet table of networks of both families (network, geo)")
    p.add_argument("--place-age", type=float, default=86_400, help="seconds that answers of --lookup are kept")
    p.add_argument("--user-window", type=int, help="also keep distinct users of windows of so many seconds")
    p.add_argument("--on-bad", default="quarantine", choices=["quarantine", "fail"])
    p.add_argument("--max-offsets", type=int, help="most messages of a topic per micro-batch")
    p.add_argument("--max-files", type=int, help="most files per micro-batch")
    p.add_argument("--max-bytes", type=int, help="most bytes of files per micro-batch")
    p.add_argument("--min-partitions", type=int, help="least read tasks per micro-batch of a topic")
    p.add_argument("--available-now", action="store_true", help="end after what is there has been read")
    return p


def check(args: argparse.Namespace) -> None:
    """Parameters a job needs beyond what the parser asks for."""
    needed = {
        "metrics": ["out"], "landing": ["out"], "print": [],
        "publish": ["broker", "files", "checkpoint"], "send": ["broker", "files"],
        "replay": ["broker", "files", "checkpoint"],
    }[args.job]
    missing = [n for n in needed if not getattr(args, n)]
    if not args.broker and not args.files:
        missing.append("broker or files")
    if missing:
        raise ValueError(f"{args.job} needs: {', '.join(missing)}")
    if sum(map(bool, (args.ranges, args.networks, args.lookup))) > 1:
        raise ValueError("give one of --ranges, --networks and --lookup, not both")


def function(name: str) -> Lookup:
    """The function named ``module:function``; executors need the module too (--py-files)."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"not of the form module:function: {name!r}")
    return getattr(importlib.import_module(module), attribute)


def source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return files.file_stream(spark, args.files, args.files_format, args.max_files, args.max_bytes)
    return kafka_stream(
        spark, args.broker, args.topic, max_offsets=args.max_offsets, min_partitions=args.min_partitions
    )


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery | None:
    common = {"seconds": args.window_seconds, "available_now": args.available_now, "checkpoint": args.checkpoint}
    if args.job in ("send", "replay"):
        records = files.RECORD_FILES[args.records](spark, args.files)
    if args.job == "replay":
        # The columns beside the message say where it lies; plain lines go in the order they are read.
        place = [c for c in records.columns if c not in ("key", "value")] or [F.monotonically_increasing_id()]
        rows = replay.numbered(records, *place).selectExpr("CAST(NULL AS STRING) AS key", "value", replay.ORDINAL)
        return replay.start(rows, replay.to_topic(args.broker, args.topic), args.pace, args.checkpoint)
    if args.job == "send":
        sinks.publish(records.selectExpr("CAST(NULL AS STRING) AS key", "value"), args.broker, args.topic)
        return None
    messages = source(spark, args)
    if args.job == "metrics":
        ranges = spark.read.schema(RANGE_SCHEMA).parquet(args.ranges) if args.ranges else None
        if args.networks:
            ranges = index_networks(spark.read.schema(NETWORK_SCHEMA).parquet(args.networks))
        lookup = function(args.lookup) if args.lookup else None
        return jobs.run_metrics(
            messages, args.out, args.topic, ranges=ranges, lookup=lookup, place_age=args.place_age,
            on_bad=args.on_bad, user_window=args.user_window, fmt=args.format, **common,
        )
    if args.job == "landing":
        return jobs.run_landing(messages, args.out, args.topic, fmt=args.format, **common)
    if args.job == "publish":
        return jobs.run_publish(messages, args.broker, args.topic, **common)
    return jobs.run_print(messages, args.topic, out=args.out, **common)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    """Runs a job until it is stopped or ends; its failure is raised, not logged away."""
    args = parser().parse_args(argv)
    check(args)
    own = spark is None
    spark = spark or SparkSession.builder.appName(f"tallystream-{args.job}").getOrCreate()
    begin = time.monotonic()
    try:
        query = start(spark, args)
        if query is not None:
            (replay if args.job == "replay" else jobs).finish(query)
        log.info("job %s took %.1f seconds", args.job, time.monotonic() - begin)
    finally:
        if own:
            spark.stop()
