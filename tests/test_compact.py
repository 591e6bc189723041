"""Compaction of batch results and the escaped line format."""

from __future__ import annotations

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tallystream.sources import files
from tallystream.streaming import commits, compact, jobs, sinks

BATCHES = 7


def write_batches(spark, out, batches, query="q"):
    """Results as the metrics job leaves them, without running it so often."""
    place = commits.manifest_path(out, "t", "metrics", "parquet")
    for b in batches:
        rows = spark.createDataFrame([(b * 10 + i, f"c{i}") for i in range(b % 3)], "n bigint, country string")
        sinks.write_batch(rows.repartition(3), out, "t", jobs.COUNTRY, b)
        now = spark.sql("SELECT current_timestamp()").first()[0]
        commits.commit(spark, place, b, query, {jobs.COUNTRY: b % 3}, now, now, now)


def rows(df):
    return sorted(tuple(r) for r in df.select("batch_id", "n", "country").collect())


def wanted(n):
    return sorted((b, b * 10 + i, f"c{i}") for b in range(n) for i in range(b % 3))


def test_few_files_while_a_reader_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compact, "FAN", 2)
    out = str(tmp_path / "out")
    assert compact.compact(spark, out, "t", jobs.COUNTRY) == []
    write_batches(spark, out, range(BATCHES))
    early = compact.results(spark, out, "t", jobs.COUNTRY)
    made = compact.compact(spark, out, "t", jobs.COUNTRY)
    assert made == [(1, 1), (1, 3), (1, 5), (2, 3)]
    assert compact.compact(spark, out, "t", jobs.COUNTRY) == []
    late = compact.results(spark, out, "t", jobs.COUNTRY)
    assert rows(early) == rows(late) == rows(commits.results(spark, out, "t", jobs.COUNTRY)) == wanted(BATCHES)
    assert compact.current_runs(spark, out, "t", jobs.COUNTRY) == [(2, 3), (1, 5), (0, 6)]
    assert len(late.inputFiles()) < len(early.inputFiles()) and len(late.inputFiles()) <= 5
    for folder in compact.replaced(spark, out, "t", jobs.COUNTRY):
        shutil.rmtree(folder)
    assert not os.path.exists(compact.run_path(out, "t", jobs.COUNTRY, "parquet", 0, 0))
    assert rows(compact.results(spark, out, "t", jobs.COUNTRY)) == wanted(BATCHES)
    assert compact.compact(spark, out, "t", jobs.COUNTRY) == []


def test_a_compaction_that_died_and_more_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compact, "FAN", 2)
    out = str(tmp_path / "out")
    write_batches(spark, out, range(4))
    plain = commits.commit
    calls = []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        plain(*args)

    monkeypatch.setattr(commits, "commit", dies)
    with pytest.raises(RuntimeError, match="lost"):
        compact.compact(spark, out, "t", jobs.COUNTRY)
    monkeypatch.setattr(commits, "commit", plain)
    assert rows(compact.results(spark, out, "t", jobs.COUNTRY)) == wanted(4)
    write_batches(spark, out, [4, 5])
    assert compact.compact(spark, out, "t", jobs.COUNTRY) == [(1, 3), (1, 5), (2, 3)]
    assert rows(compact.results(spark, out, "t", jobs.COUNTRY)) == wanted(6)


def test_a_gap_is_left_alone(spark, tmp_path, monkeypatch):
    """A batch without a manifest is neither read nor merged."""
    monkeypatch.setattr(compact, "FAN", 2)
    out = str(tmp_path / "out")
    write_batches(spark, out, [0, 1, 3])
    assert compact.compact(spark, out, "t", jobs.COUNTRY) == [(1, 1)]
    assert {r[0] for r in rows(compact.results(spark, out, "t", jobs.COUNTRY))} == {1}  # 0 and 3 are empty


# Lines

AWKWARD = [
    "a\nb", "\\n", "\\\\n", "\\", "\\\\", "x\r\ny", "", "\\N", None, "\n", "\\\n", "\\\\\n", "é\\nq", "a\\", "\\\\\\n", "\u2028", " s ", "\x0b\x85",
]


def test_lines_come_back_whole(spark, tmp_path):
    rng = random.Random(9)
    values = AWKWARD + ["".join(rng.choices("\\nNr\n\ra ", k=rng.randint(0, 9))) for _ in range(300)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(None, v) for v in values], "key string, value string").write.parquet(source)
    stream = files.file_stream(spark, source, fmt="parquet")
    jobs.finish(jobs.run_landing(stream, out, "t", fmt="lines", available_now=True))
    path = sinks.result_path(out, "t", jobs.LANDED, "lines")
    got = [r["value"] for r in sinks.read_lines(spark, path).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, values))
    lines = [line for f in os.listdir(path) if f.endswith(".txt") for line in open(f"{path}/{f}", newline="").read().split("\n")[:-1]]
    assert len(lines) == len(values)


def test_lines_are_read_in_splits(spark, tmp_path):
    spark.range(1000).select(sinks.as_line(F.concat(F.lit("a\n"), F.col("id"))).alias("value")).coalesce(1).write.text(str(tmp_path / "x"))
    assert sinks.read_lines(spark, str(tmp_path / "x")).where("value LIKE 'a\n%'").count() == 1000
