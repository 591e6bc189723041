"""Whole batches, progress of every batch and users over many batches."""

from __future__ import annotations

import os
import random
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallystream.operators import messages as msg
from tallystream.plans import inputs
from tallystream.sources import files
from tallystream.streaming import cli, commits, jobs, progress, sinks, users
from tallystream.workspace import settings

PARTS = 3
ALL = (jobs.RAW, jobs.COUNTRY, jobs.USERS, jobs.GENDER, jobs.IP, jobs.QUARANTINE)


@pytest.fixture()
def topic_dir(spark, sf_dir, tmp_path):
    path = str(tmp_path / "topic")
    inputs_ = msg.to_envelope(inputs.flawed_messages(spark, sf_dir))
    inputs_.repartition(PARTS, "key").write.json(path)
    return path


def run(spark, path, out, **kw):
    stream = files.file_stream(spark, path, max_files=1)
    jobs.finish(jobs.run_metrics(stream, out, "users", available_now=True, **kw))


def batches(df):
    return {r["batch_id"] for r in df.select("batch_id").distinct().collect()}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_manifest_counts_what_is_written(spark, sf_dir, topic_dir, tmp_path, fmt):
    out = str(tmp_path / "out")
    run(spark, topic_dir, out, ranges=inputs.ip_ranges(spark, sf_dir), fmt=fmt)
    listed = {(r["batch_id"], r["metric"]): r["rows"] for r in commits.manifest(spark, out, "users", fmt).collect()}
    found = {}
    for metric in ALL:
        schema = None if fmt == "parquet" else "batch_time timestamp, n bigint"
        rows = commits.results(spark, out, "users", metric, fmt, schema)
        found |= {(r["batch_id"], metric): r["count"] for r in rows.groupBy("batch_id").count().collect()}
    assert listed == found and len(listed) == PARTS * len(ALL)
    times = commits.manifest(spark, out, "users", fmt).select("batch_id", "batch_time").distinct().collect()
    assert len(times) == PARTS and all(r["batch_time"] for r in times)


def test_half_a_batch_is_not_shown(spark, sf_dir, topic_dir, tmp_path, monkeypatch):
    """A batch that dies between two writes: nothing of it is read until it has run again."""
    out, plain = str(tmp_path / "out"), sinks.write_batch

    def dies(df, out, topic, metric, batch_id, *args):
        if metric == jobs.GENDER and batch_id == 1:
            raise RuntimeError("lost")
        plain(df, out, topic, metric, batch_id, *args)

    monkeypatch.setattr(sinks, "write_batch", dies)
    with pytest.raises(StreamingQueryException):
        run(spark, topic_dir, out)
    assert batches(spark.read.parquet(sinks.result_path(out, "users", jobs.RAW))) == {0, 1}
    assert batches(commits.results(spark, out, "users", jobs.RAW)) == {0}
    assert batches(commits.progress(spark, out, "users")) == {0}
    monkeypatch.setattr(sinks, "write_batch", plain)
    run(spark, topic_dir, out)
    raw = commits.results(spark, out, "users", jobs.RAW)
    assert batches(raw) == {0, 1, 2}
    assert raw.count() == inputs.table(spark, sf_dir, "events").count()


def _forget_commit(out, batch):
    folder = f"{out}/users/checkpoints/metrics-parquet/commits"
    os.unlink(f"{folder}/{batch}")
    if os.path.exists(f"{folder}/.{batch}.crc"):
        os.unlink(f"{folder}/.{batch}.crc")


def test_a_whole_batch_is_not_written_again(spark, topic_dir, tmp_path):
    out = str(tmp_path / "out")
    run(spark, topic_dir, out)
    folder = f"{sinks.result_path(out, 'users', jobs.COUNTRY)}/batch_id={PARTS - 1}"
    before = sorted(os.listdir(folder)), commits.manifest(spark, out, "users").orderBy("batch_id", "metric").collect()
    _forget_commit(out, PARTS - 1)
    run(spark, topic_dir, out)
    after = sorted(os.listdir(folder)), commits.manifest(spark, out, "users").orderBy("batch_id", "metric").collect()
    assert before == after


def test_another_query_replaces_the_results(spark, topic_dir, tmp_path):
    """A new checkpoint reads everything again, in one batch: the old batches are no longer part of the results."""
    out = str(tmp_path / "out")
    run(spark, topic_dir, out)
    count = commits.results(spark, out, "users", jobs.RAW).count()
    stream = files.file_stream(spark, topic_dir)
    jobs.finish(jobs.run_metrics(stream, out, "users", available_now=True, checkpoint=str(tmp_path / "other")))
    raw = commits.results(spark, out, "users", jobs.RAW)
    assert batches(raw) == {0} and raw.count() == count


def test_readers_find_nothing_before_the_first_batch(spark, tmp_path):
    out = str(tmp_path / "out")
    assert commits.manifest(spark, out, "users").count() == 0
    assert commits.progress(spark, out, "users").count() == 0
    assert progress.batches(spark, out, "users", "landing").count() == 0
    assert users.window_users(spark, out, "users", 60).count() == 0


def test_progress_has_every_batch(spark, tmp_path):
    """Far more batches than Spark remembers, over a restart, none twice."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    n = 0
    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "2"}):
        for part in (6, 4):
            for _ in range(part):
                (source / f"{n}.json").write_text('{"value":"{}"}\n' * (n + 1))
                os.utime(source / f"{n}.json", (1_700_000_000 + n,) * 2)
                n += 1
            stream = files.file_stream(spark, str(source), max_files=1)
            query = jobs.run_landing(stream, out, "t", available_now=True)
            jobs.finish(query)
            assert len(query.recentProgress) <= 2
    rows = progress.batches(spark, out, "t", "landing").orderBy("batch_id").collect()
    assert [(r["batch_id"], r["input_rows"]) for r in rows] == [(i, i + 1) for i in range(10)]
    assert all(r["millis"] > 0 and r["started"] for r in rows)


def test_progress_gap_is_filled(spark, tmp_path):
    """A driver that died before it could report its last batch."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n in range(3):
        (source / f"{n}.json").write_text('{"value":"{}"}\n')
        stream = files.file_stream(spark, str(source), max_files=1)
        jobs.finish(jobs.run_landing(stream, out, "t", available_now=True))
        if n == 1:
            shutil.rmtree(f"{progress.progress_path(out, 't', 'landing', 'parquet')}/batch_id=1")
    rows = progress.batches(spark, out, "t", "landing").orderBy("batch_id").collect()
    assert [(r["batch_id"], r["input_rows"]) for r in rows] == [(0, 1), (1, None), (2, 1)]
    assert rows[0]["started"] <= rows[1]["started"] <= rows[2]["started"]


def test_listener_goes_with_its_query(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('{"value":"{}"}\n')
    out = str(tmp_path / "out")
    cli.main(["landing", "--topic", "t", "--files", str(source), "--out", out, "--available-now"], spark)
    assert not jobs._LOGS
    assert progress.batches(spark, out, "t", "landing").count() == 1


# Users over batches

def test_covered():
    assert users.FAN >= 2
    rng = random.Random(1)
    for _ in range(200):
        fan, n = rng.choice([2, 3, 8]), rng.randint(0, 70)
        whole = [b for b in range(n) if rng.random() < 0.97]
        levels, size = [], fan
        while size <= max(n, 1):
            levels.append({last for last in range(size - 1, n, size) if rng.random() < 0.8})
            size *= fan
        chosen = commits.covered(whole, levels, fan)
        held = [b for level, last in chosen for b in range(last - fan**level + 1, last + 1)]
        assert sorted(held) == whole
        assert all(level == 0 or last in levels[level - 1] for level, last in chosen)
    assert commits.covered(range(73), [set(range(7, 73, 8)), {63}], 8) == [(2, 63), (1, 71), (0, 72)]


def expected_users(spark, sf_dir, seconds):
    good = msg.accepted(msg.decode(msg.to_envelope(inputs.flawed_messages(spark, sf_dir))))
    days = good.withColumn("w", (F.unix_seconds(F.col("timestamp").cast("timestamp")) / seconds).cast("bigint"))
    rows = days.groupBy("w").agg(F.count_distinct("email"), F.count("*")).collect()
    return {r[0]: (r[1], r[2]) for r in rows}


def found_users(spark, out, seconds):
    rows = users.window_users(spark, out, "users", seconds).collect()
    return {int(r["window_start"].timestamp()) // seconds: (r["unique_users"], r["message_total"]) for r in rows}


def test_users_of_windows_over_many_batches(spark, sf_dir, tmp_path, monkeypatch):
    """Seven batches in three starts; runs of two and four batches are merged, one merge dies."""
    monkeypatch.setattr(users, "FAN", 2)
    path, out, seconds = str(tmp_path / "topic"), str(tmp_path / "out"), 7 * 86400
    rows = msg.to_envelope(inputs.flawed_messages(spark, sf_dir))
    rows.repartition(7, "key").write.json(path)
    names = sorted(f for f in os.listdir(path) if f.endswith(".json"))
    os.mkdir(f"{path}-read")

    def more(count):
        for _ in range(count):
            name = names.pop()
            os.rename(f"{path}/{name}", f"{path}-read/{name}")

    more(3)
    run(spark, f"{path}-read", out, user_window=seconds)
    plain, died = users.merged, []

    def dies(runs):
        if not died:
            died.append(1)
            raise RuntimeError("lost")
        return plain(runs)

    more(2)
    monkeypatch.setattr(users, "merged", dies)
    with pytest.raises(StreamingQueryException):
        run(spark, f"{path}-read", out, user_window=seconds)
    run(spark, f"{path}-read", out, user_window=seconds)
    more(2)
    run(spark, f"{path}-read", out, user_window=seconds)
    assert not names
    assert found_users(spark, out, seconds) == expected_users(spark, sf_dir, seconds)
    chosen = users.current_runs(spark, out, "users", seconds)
    assert chosen == [(2, 3), (1, 5), (0, 6)]
    first = users.all_users(spark, out, "users", seconds)
    assert first.select("window_start", "email").distinct().count() == first.count()
    assert batches(first.withColumnRenamed("first_batch", "batch_id")) <= set(range(7))


def test_user_window_is_checked(spark, topic_dir, tmp_path):
    stream = files.file_stream(spark, topic_dir)
    with pytest.raises(ValueError, match="window length"):
        jobs.run_metrics(stream, str(tmp_path), "t", user_window=0)
