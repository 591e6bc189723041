"""Replay by a clock."""

from __future__ import annotations

import os
from decimal import Decimal
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from tallystream.operators import messages as msg
from tallystream.streaming import cli, replay, sinks


def messages_of(spark, n):
    records = spark.range(n).select(F.col("id").alias("at"), (F.col("id") * 7 % n).cast("string").alias("email"))
    return replay.numbered(msg.encode(records, ["email"]).repartition(5), "at")


@pytest.mark.parametrize("seconds", ["0.1", "0.3", "1", "2", "2.5", "0.007"])
def test_every_number_is_due_once_and_in_time(seconds):
    pace = Decimal(seconds)
    rate = max(1, int(1 / pace) + 1)
    edges = [0, 1, 2, 3, 7, 8, 40, 200, 5000]
    spans = [replay.due(a, b - 1, rate, pace) for a, b in pairwise(edges)]
    assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in pairwise(spans))
    for (a, b), (low, high) in zip(pairwise(edges), spans, strict=True):
        for i in range(low, min(high, low + 300)):
            assert a <= i * pace * rate < b


def test_messages_leave_at_their_time(spark, tmp_path):
    """Whatever the files: five of them, forty messages, one every tenth of a second."""
    rows = messages_of(spark, 40)
    out = str(tmp_path / "out")
    query = replay.start(rows, replay.to_folder(out), 0.1, str(tmp_path / "state"), trigger="500 milliseconds")
    replay.finish(query)
    left = spark.read.json(out).withColumn("at_time", F.col("left_at").cast("timestamp")).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in left] == list(range(40)) and [r["at"] for r in left] == list(range(40))
    begin = left[0]["at_time"]
    late = [(r["at_time"] - begin).total_seconds() - r["ordinal"] * 0.1 for r in left]
    # The clock shows whole seconds, a trigger comes every half: never a second early, nor far behind.
    assert min(late) > -1.5 and max(late) < 3.5
    assert len({r["batch_id"] for r in left}) >= 3


def test_a_stopped_replay_goes_on(spark, tmp_path):
    rows, out, state = messages_of(spark, 30), str(tmp_path / "out"), str(tmp_path / "state")
    query = replay.start(rows, replay.to_folder(out), 0.1, state, trigger="200 milliseconds")
    while not (os.path.exists(out) and os.listdir(out)):
        query.awaitTermination(1)
    query.stop()
    query.awaitTermination()
    replay.finish(replay.start(rows, replay.to_folder(out), 0.1, state, trigger="200 milliseconds"))
    got = [r["ordinal"] for r in spark.read.json(out).collect()]
    assert sorted(got) == list(range(30))


def test_release_into_a_topic(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(sinks, "publish", lambda df, *to: sent.append((df.columns, to)))
    replay.to_topic("b:1", "t")(messages_of(spark, 2), 0)
    assert sent == [(["key", "value", "at", "ordinal"], ("b:1", "t"))]


def test_command_line(spark, tmp_path, monkeypatch):
    sent = []
    monkeypatch.setattr(sinks, "publish", lambda df, *to: sent.extend(r["value"] for r in df.orderBy("ordinal").collect()))
    (tmp_path / "a.json").write_text('[{"a":1},{"a":2},{"a":3}]')
    common = ["replay", "--topic", "t", "--broker", "b", "--files", str(tmp_path / "a.json"), "--pace", "0.2"]
    cli.main([*common, "--records", "array-split", "--checkpoint", str(tmp_path / "state")], spark)
    assert sent == ['{"a":1}', '{"a":2}', '{"a":3}']
    (tmp_path / "b.json").write_text('{"b":1}\n{"b":2}\n')
    common[6] = str(tmp_path / "b.json")
    cli.main([*common, "--records", "lines", "--checkpoint", str(tmp_path / "other")], spark)
    assert sent[3:] == ['{"b":1}', '{"b":2}']
    with pytest.raises(ValueError, match="replay needs: broker, files, checkpoint"):
        cli.main(["replay", "--topic", "t"], spark)


def test_pace_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="positive"):
        replay.start(messages_of(spark, 1), print, 0, str(tmp_path))


def test_a_batch_reads_only_its_files(spark):
    rows = messages_of(spark, 100).where(F.col("ordinal").between(3, 5))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ordinal,3)" in plan
