"""Windows, schedules, ordinals, file sources, metric properties and plan shapes."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallystream import workspace
from tallystream.functions.times import instant_to_ntz, ntz_to_instant
from tallystream.operators import messages as msg, metrics
from tallystream.operators.ordering import with_ordinal
from tallystream.operators.windows import arrival_schedule, assign_window, window_seconds
from tallystream.plans import inputs
from tallystream.sources import files

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def windowed(spark, sf_dir):
    return assign_window(inputs.decoded_users(spark, sf_dir), "timestamp", 7 * 3600).cache()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Metrics

def test_metric_properties(windowed):
    total = {r["window_start"]: r["n"] for r in metrics.message_total(windowed).collect()}
    users = {r["window_start"]: r["n"] for r in metrics.unique_users(windowed).collect()}
    for counts in (metrics.country_count, metrics.gender_count, metrics.email_count):
        rows = counts(windowed).groupBy("window_start").agg(F.sum("n").alias("n")).collect()
        assert {r["window_start"]: r["n"] for r in rows} == total
    assert sum(total.values()) == windowed.count()
    assert all(users[w] <= total[w] for w in total)
    per_email = metrics.email_count(windowed).groupBy("window_start").count().collect()
    assert {r["window_start"]: r["count"] for r in per_email} == users


def test_null_rules(spark):
    rows = [(1, None, None, None), (1, "a", None, "F"), (2, None, "X", None)]
    df = spark.createDataFrame(rows, "window_start int, email string, country string, gender string")
    users = {(r["window_start"], r["n"]) for r in metrics.unique_users(df).collect()}
    total = {(r["window_start"], r["n"]) for r in metrics.message_total(df).collect()}
    assert users == {(1, 1), (2, 0)} and total == {(1, 2), (2, 1)}
    assert {tuple(r) for r in metrics.country_count(df).collect()} == {(1, None, 2), (2, "X", 1)}
    got = Counter(tuple(r) for r in metrics.all_metrics(df).collect())
    assert got == Counter([
        (1, "country", None, 2), (2, "country", "X", 1),
        (1, "gender", None, 1), (1, "gender", "F", 1), (2, "gender", None, 1),
        (1, "message_total", None, 2), (2, "message_total", None, 1),
    ])


def test_no_rows_no_window(spark):
    df = spark.createDataFrame([], "window_start int, email string, country string, gender string")
    for metric in (metrics.message_total, metrics.unique_users, metrics.country_rank, metrics.all_metrics):
        assert metric(df).count() == 0


def test_rank_orders_ties_by_name_and_null_last(spark):
    rows = [(1, c) for c in ["b", "b", "a", "c", None, None, "d"]]
    df = spark.createDataFrame(rows, "window_start int, country string")
    got = [(r["country"], r["rk"]) for r in sorted(metrics.country_rank(df).collect(), key=lambda r: r["rk"])]
    assert got == [("b", 1), (None, 2), ("a", 3), ("c", 4), ("d", 5)]


def test_counts_combine_before_the_shuffle(windowed):
    for metric in (metrics.country_count, metrics.gender_count, metrics.message_total, metrics.all_metrics):
        assert re.search(r"Exchange hashpartitioning.*\n.*partial_count", plan_of(metric(windowed)))


def test_distinct_users_are_spread_by_user(windowed):
    """The users of a window are counted in many tasks, not in the window's own."""
    first = re.findall(r"Exchange hashpartitioning\((.*?)\)", plan_of(metrics.unique_users(windowed)))[1]
    assert "email" in first


def test_counts_run_on_a_stream(spark, sf_dir, tmp_path):
    """Metric functions other than rank and distinct take streaming frames as well."""
    path = str(tmp_path / "topic")
    inputs.write_topic_files(inputs.topic_messages(spark, sf_dir), path)
    good = msg.accepted(msg.decode(files.file_stream(spark, path, fmt="parquet")))
    counts = metrics.country_count(assign_window(good, "timestamp", 86400))
    query = (
        counts.writeStream.format("memory").queryName("stream_counts").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = assign_window(inputs.decoded_users(spark, sf_dir), "timestamp", 86400)
    got = spark.table("stream_counts").withColumn("window_start", instant_to_ntz(F.col("window_start")))
    expected = metrics.country_count(batch)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


def test_all_metrics_expands_counts_not_messages(windowed):
    above, below = plan_of(metrics.all_metrics(windowed)).split("Expand")
    assert "partial_count" in below and "partial_count" not in above


def test_scan_reads_only_the_columns_needed(spark, sf_dir):
    users = assign_window(inputs.decoded_users(spark, sf_dir), "timestamp", 60)
    text = plan_of(metrics.country_count(users))
    assert "event_type" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text


def test_busy_user_is_split(spark, tmp_path):
    """With customers too many to broadcast, a user with most events does not
    end up in one task."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        user = F.when(F.col("id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("id") % 500)
        spark.range(0, 60_000, numPartitions=8).select(
            F.col("id").alias("event_id"), F.lit(START).cast("timestamp_ntz").alias("ts"),
            user.alias("user_id"), F.lit("view").alias("event_type"),
        ).write.parquet(str(tmp_path / "events.parquet"))
        for name in ("customer", "nation"):
            part = inputs.table(spark, "/root/testdata/sf0.01", name)
            part.write.parquet(str(tmp_path / f"{name}.parquet"))
        records = inputs.user_records(spark, str(tmp_path))
        emails = Counter(r["email"] for r in records.collect())
        assert "skew=true" in plan_of(records)
        assert sum(emails.values()) == 60_000
        assert emails["user1@example.com"] == sum(1 for i in range(60_000) if i % 3 == 0 or i % 500 == 1)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Windows and schedules

def test_window_seconds():
    assert window_seconds("10") == 10
    for bad in (0, -5, "x", None, ""):
        with pytest.raises(ValueError):
            window_seconds(bad)


def test_each_message_is_in_one_window(windowed):
    rows = windowed.select("timestamp", "window_start").collect()
    width = dt.timedelta(hours=7)
    assert all(w <= t < w + width for t, w in rows)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("seconds", [0, 1, 2, 0.25])
def test_arrival_schedule(spark, zone, seconds):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = arrival_schedule(spark.range(0, 5000, 997), "id", START, seconds).collect()
        assert all(r["arrival_ts"] == START + dt.timedelta(seconds=r["id"] * seconds) for r in rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        wait = F.make_dt_interval(secs=(F.col("id") / 1000).cast("decimal(18,6)"))
        start = F.lit("2023-12-31 23:59:59.123456").cast("timestamp_ntz")
        times = spark.range(0, 90_000_000_000, 1_799_999_999).select((start + wait).alias("t"))
        back = times.withColumn("back", instant_to_ntz(ntz_to_instant(F.col("t"))))
        assert back.where(F.col("t") == F.col("back")).count() == times.count()
        first = times.select(F.unix_micros(ntz_to_instant(F.col("t")))).orderBy(F.asc("t")).first()[0]
        assert first == 1704067199123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_negative_pace_is_refused(spark):
    with pytest.raises(ValueError):
        arrival_schedule(spark.range(1), "id", START, -1)


@pytest.mark.parametrize("parts", [1, 7])
def test_with_ordinal(spark, parts):
    df = spark.range(0, 5000, numPartitions=parts).select(
        (F.hash("id") % 100).alias("k"), F.col("id").alias("v")
    )
    got = with_ordinal(df, "k", F.desc("v")).collect()
    expected = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], -r[1]))
    assert [(r["k"], r["v"]) for r in sorted(got, key=lambda r: r["ordinal"])] == expected
    assert sorted(r["ordinal"] for r in got) == list(range(5000))


def test_ordinal_of_a_hot_key_uses_several_partitions(spark):
    df = spark.range(0, 20_000, numPartitions=8).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_ordinal(df, "k")
        assert sorted(r["ordinal"] for r in got.collect()) == list(range(20_000))
        parts = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


# Files

RECORDS = [
    {"id": 1, "email": "a", "gender": None, "country": "X", "ip_address": "1.1.1.1"},
    {"email": "b", "country": "Y", "more": [1, {"z": "é"}]},
    "text", 5, None, [1],
]


def test_json_array_keeps_order_and_absence(spark, tmp_path):
    for name, part in (("a.json", RECORDS), ("b.json", RECORDS[:2]), ("c.json", [])):
        (tmp_path / name).write_text(json.dumps(part, indent=1))
    rows = files.json_array(spark, str(tmp_path)).collect()
    by_file = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["position"])):
        by_file.setdefault(r["file"].rsplit("/", 1)[1], []).append(r["value"])
    assert set(by_file) == {"a.json", "b.json"}
    assert [json.loads(v) for v in by_file["b.json"]] == RECORDS[:2]
    decoded = msg.decode(files.json_array(spark, str(tmp_path / "a.json")))
    reasons = [r["reason"] for r in sorted(decoded.collect(), key=lambda r: r["position"])]
    assert reasons == [None, "missing:gender"] + ["malformed"] * 4


@pytest.mark.parametrize("style", ["{0}", " {0} "])
@pytest.mark.parametrize("first, sep, last", [("[", ",\n", "]"), ("[\n", ",\n", "\n]\n"), ("[", "\n,", "]")])
def test_json_array_lines(spark, tmp_path, style, first, sep, last):
    records = RECORDS[:2] + [{"a": [1]}, {"country": "]"}, {"b": ["[,"]}]
    text = first + sep.join(style.format(json.dumps(r)) for r in records) + last
    if sep == "\n,":
        text = text.replace("\n,", ",\n")
    (tmp_path / "a.json").write_text(text)
    rows = files.json_array_lines(spark, str(tmp_path)).orderBy("file", "block", "line").collect()
    assert [json.loads(r["value"]) for r in rows] == records
    whole = files.json_array(spark, str(tmp_path)).orderBy("position").collect()
    assert [json.loads(r["value"]) for r in whole] == records


def test_large_json_array_is_split(spark, tmp_path):
    records = [{"n": i, "pad": "x" * 50} for i in range(3000)]
    (tmp_path / "a.json").write_text("[" + ",\n".join(map(json.dumps, records)) + "]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    try:
        lines = files.json_array_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        got = with_ordinal(lines, "file", "block", "line").orderBy("ordinal").collect()
        assert [json.loads(r["value"])["n"] for r in got] == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_array_must_be_an_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"email": 1')
    with pytest.raises(PySparkException, match="not a JSON array"):
        files.json_array(spark, str(tmp_path)).collect()


def test_json_lines_are_verbatim(spark, tmp_path):
    lines = ['{"b":1,  "a":2}', "not json", " {} "]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    assert [r["value"] for r in files.json_lines(spark, str(tmp_path)).collect()] == lines


def test_replay_of_several_files(spark, tmp_path):
    for name in ("a", "b", "c"):
        items = [{"n": f"{name}{i}"} for i in range(5)]
        (tmp_path / f"{name}.json").write_text(json.dumps(items))
    rows = with_ordinal(files.json_array(spark, str(tmp_path)), "file", "position")
    timed = arrival_schedule(rows, "ordinal", START, 2).orderBy("arrival_ts").collect()
    assert [json.loads(r["value"])["n"] for r in timed] == [f"{n}{i}" for n in "abc" for i in range(5)]
    assert timed[-1]["arrival_ts"] == START + dt.timedelta(seconds=28)


# Shared folder

def test_shared_folder_is_read_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace.shared_root(spark) == root
    first, second = (workspace.new_folder(spark, "x") for _ in range(2))
    assert first != second and first.startswith(f"{root}/tallystream/x-")


class FakeSession:
    """A session of a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_root(FakeSession)


def test_rows_without_a_time_share_a_window(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP_NTZ '1969-12-31 23:59:58.5'), ('b', NULL), ('c', TIMESTAMP_NTZ '1970-01-01 00:00:10') AS t(country, ts)")
    for cast in ("timestamp_ntz", "timestamp"):
        got = assign_window(rows.withColumn("ts", F.col("ts").cast(cast)), "ts", 10)
        starts = {r["country"]: r["s"] for r in got.selectExpr("country", "CAST(window_start AS STRING) s").collect()}
        assert starts == {"a": "1969-12-31 23:59:50", "b": None, "c": "1970-01-01 00:00:10"}
        assert metrics.country_rank(got).groupBy().sum("n").first()[0] == 3
