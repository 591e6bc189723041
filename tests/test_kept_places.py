"""Indexes written once and answers of a lookup kept over batches."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallystream.operators import enrich, frozen, messages as msg
from tallystream.operators.networks import index_networks
from tallystream.operators.ranges import RangeIndex, index_ranges
from tallystream.plans import inputs
from tallystream.sources import files
from tallystream.streaming import commits, jobs

PARTS = 3


@pytest.fixture()
def topic_dir(spark, sf_dir, tmp_path):
    path = str(tmp_path / "topic")
    msg.to_envelope(inputs.flawed_messages(spark, sf_dir)).repartition(PARTS, "key").write.json(path)
    return path


def run(spark, path, out, **kw):
    stream = files.file_stream(spark, path, max_files=1)
    jobs.finish(jobs.run_metrics(stream, out, "users", available_now=True, **kw))


def places(df):
    return sorted((str(r["id"]), r["geo"] and r["geo"]["city"]) for r in df.select("id", "geo").collect())


@pytest.mark.parametrize("form", ["broadcast", "sorted", "networks", "networks shuffled"])
def test_frozen_index_gives_the_same_places(spark, sf_dir, tmp_path, form):
    index = {
        "broadcast": lambda: index_ranges(inputs.ip_ranges(spark, sf_dir)),
        "sorted": lambda: RangeIndex(inputs.ip_ranges(spark, sf_dir)),
        "networks": lambda: index_networks(inputs.ip_networks(spark, sf_dir)),
        "networks shuffled": lambda: index_networks(inputs.ip_networks(spark, sf_dir), 0),
    }[form]()
    df = spark.createDataFrame([(i, f"{i}.1.2.3") for i in range(256)] + [(999, None)], "id int, ip_address string")
    path = str(tmp_path / "index")
    kept = frozen.freeze(spark, index, path)
    assert places(enrich.ip_enrich(df, kept)) == places(enrich.ip_enrich(df, index))
    assert frozen.freeze(spark, kept, path) is kept
    plan = enrich.ip_enrich(df, kept)._jdf.queryExecution().optimizedPlan().toString()
    assert "nation" not in plan and "r_name" not in plan


def test_versions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "index")
    with pytest.raises(ValueError, match="no such index"):
        frozen.load(spark, path)
    ranges = inputs.ip_ranges(spark, sf_dir)
    assert [frozen.save(spark, index_ranges(r), path) for r in (ranges, ranges.limit(1), ranges)] == [0, 1, 2]
    assert frozen.load(spark, path, 1).ranges.count() == 1 and frozen.load(spark, path).ranges.count() > 1
    os.rename(f"{path}/versions/version=2", f"{path}/versions/_unfinished")  # a save that died before its last write
    assert frozen.load(spark, path).ranges.count() == 1
    assert frozen.save(spark, index_ranges(ranges), path) == 2


def test_a_stream_builds_its_index_once(spark, sf_dir, topic_dir, tmp_path, monkeypatch):
    built = []
    plain = frozen.save
    monkeypatch.setattr(frozen, "save", lambda *a: built.append(1) or plain(*a))
    out = str(tmp_path / "out")
    run(spark, topic_dir, out, ranges=inputs.ip_ranges(spark, sf_dir))
    assert len(commits.progress(spark, out, "users").collect()) == PARTS and len(built) == 1


def asking(folder):
    """A lookup that leaves a line for every address it is asked for."""

    def lookup(addresses: pd.Series) -> pd.DataFrame:
        with open(f"{folder}/{os.getpid()}", "a") as f:
            f.writelines(f"{a}\n" for a in addresses)
        return pd.DataFrame({"city": "at " + addresses})

    return lookup


def asked(folder):
    return Counter(line.strip() for name in os.listdir(folder) for line in open(f"{folder}/{name}"))


def test_addresses_are_asked_once_over_batches(spark, sf_dir, topic_dir, tmp_path, monkeypatch):
    log, out = tmp_path / "asked", str(tmp_path / "out")
    log.mkdir()
    monkeypatch.setattr(jobs, "COMPACT_EVERY", 2)
    run(spark, topic_dir, out, lookup=asking(str(log)))
    with open(f"{topic_dir}/later.json", "w") as f:
        record = '{"email":null,"gender":null,"country":null,"ip_address":%s}'
        for address in ('"77.7.7.7"', '"77.7.7.7"', "null"):
            f.write('{"value":"%s"}\n' % (record % address).replace('"', '\\"'))
        first = commits.results(spark, out, "users", jobs.IP).select("ip_address").first()[0]
        f.write('{"value":"%s"}\n' % (record % f'"{first}"').replace('"', '\\"'))
    run(spark, topic_dir, out, lookup=asking(str(log)))
    good = msg.accepted(msg.decode(msg.to_envelope(inputs.flawed_messages(spark, sf_dir))))
    wanted = {r[0] for r in good.select("ip_address").distinct().collect()} | {"77.7.7.7"}
    assert asked(log) == Counter(dict.fromkeys(wanted, 1))
    rows = commits.results(spark, out, "users", jobs.IP)
    assert rows.count() == good.count() + 4
    assert rows.where("NOT geo.city <=> 'at ' || ip_address").count() == 0
    assert rows.where("ip_address IS NULL AND geo IS NULL").count() == 1


def test_age_compaction_and_the_latest_answer(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()
    table = enrich.PlaceTable(str(tmp_path / "places"), asking(str(log)), max_age=60)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, ip_address string").withColumn("_key", F.lit(0))
    begin = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for seconds, total in ((0, 1), (59, 1), (61, 2), (100, 2)):
        found = table.enrich(df, begin + timedelta(seconds=seconds))
        assert found.columns == [*df.columns, "geo"]
        assert places(found) == [("1", "at a"), ("2", "at b"), ("3", "at a"), ("4", None)]
        assert asked(log) == Counter(a=total, b=total)
    table.compact(spark)
    assert table.known(spark).count() == 2
    assert spark.read.schema(enrich.PLACE).parquet(str(tmp_path / "places/places/1")).count() == 2
    table.enrich(df, begin + timedelta(seconds=110)).collect()
    assert asked(log) == Counter(a=2, b=2)
    os.rename(tmp_path / "places/generations/generation=1", tmp_path / "places/generations/_died")
    assert table.known(spark).count() == 2  # the older generation still answers
    other = enrich.PlaceTable(str(tmp_path / "places"), lambda a: pd.DataFrame({"city": "new " + a}), max_age=60)
    assert places(other.enrich(df, begin + timedelta(seconds=500)))[0] == ("1", "new a")


def test_rows_without_address_are_spread(spark):
    """As null keys they would all meet in one task of the join."""
    df = spark.range(1000).select("id", F.lit(None).cast("string").alias("ip_address"))
    plan = enrich.lookup_enrich(df, lambda a: pd.DataFrame({"city": a}))._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in plan
    index = RangeIndex(spark.createDataFrame([(0, 5, None)], f"lo bigint, hi bigint, geo {enrich.GEO_STRUCT.simpleString()}"))
    located = enrich.ip_enrich(df, index)
    assert located.count() == 1000 and "monotonically_increasing_id" in located._jdf.queryExecution().optimizedPlan().toString()
