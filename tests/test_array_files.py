"""JSON array files read in splits, against Python's json module."""

from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.errors import PySparkException

from tallystream.sources import files
from tallystream.workspace import settings


def elements(spark, path, split_bytes):
    tiny = {"spark.sql.files.maxPartitionBytes": str(split_bytes), "spark.sql.files.openCostInBytes": "1"}
    with settings(spark, tiny):
        rows = files.json_array_split(spark, str(path)).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["block"], r["line"])):
        out.setdefault(r["file"].rsplit("/", 1)[1], []).append(r["value"])
    return out


def scalar(rng):
    text = "".join(rng.choices('ab,,[]{}:"\\\n é€', k=rng.randint(0, 9)))
    return rng.choice([text, text, rng.randint(-99, 9999), None, True, 1.5])


def value(rng, depth=0):
    kind = rng.random()
    if depth > 2 or kind < 0.4:
        return scalar(rng)
    if kind < 0.6:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {str(scalar(rng)): value(rng, depth + 1) for _ in range(rng.randint(0, 4))}


@pytest.mark.parametrize("split_bytes", [5, 37, 1000])
def test_splits_do_not_matter(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    arrays = {f"{i}.json": [value(rng) for _ in range(rng.choice([0, 1, 2, 9, 30]))] for i in range(12)}
    for i, (name, items) in enumerate(arrays.items()):
        text = json.dumps(items, ensure_ascii=i % 2 == 0, indent=[None, 1, 4][i % 3])
        (tmp_path / name).write_text([text, f" \n{text}\n\n"][i % 2])
    got = elements(spark, tmp_path, split_bytes)
    assert {k: [json.loads(v) for v in vs] for k, vs in got.items()} == {k: v for k, v in arrays.items() if v}


def test_text_of_elements_is_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a" : 1.50,\n"b":[ ]} , "x,]" ,null\t]')
    assert elements(spark, tmp_path, 3) == {"a.json": ['{"a" : 1.50,\n"b":[ ]}', '"x,]"', "null"]}


def test_one_large_array_in_many_splits(spark, tmp_path):
    items = [{"i": i, "t": ",]}" * (i % 5), "n": [i, [i]]} for i in range(4000)]
    (tmp_path / "big.json").write_text(json.dumps(items))
    tiny = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}
    with settings(spark, tiny):
        assert files._pieces(spark, str(tmp_path)).select("block").distinct().count() > 40
        got = files.json_array_split(spark, str(tmp_path)).orderBy("block", "line").collect()
    assert [json.loads(r["value"]) for r in got] == items


@pytest.mark.parametrize("text", [
    '{"a":1}', "[1,2", "1,2]", "[1,2]]", "[1],[2]", "[1,]", "[,1]", "[1,,2]", '["a,b]', "x", "[1] x", "[1]\n[2]", ",", "[1],",
    '[{"a":1}{"b":2}]', "[[]\t[]]", '["a",{}[]]',
])
def test_no_array_stops_the_job(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    for split_bytes in (2, 1000):
        with pytest.raises(PySparkException, match="not a JSON array"):
            elements(spark, tmp_path, split_bytes)


def test_first_pass_moves_no_text(spark, tmp_path):
    """The states of the blocks are found without shuffling the pieces themselves."""
    (tmp_path / "a.json").write_text("[1,2]")
    with settings(spark, {"spark.sql.debug.maxToStringFields": "200"}):
        plan = files._block_states(files._pieces(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    moved = re.search(r"Exchange hashpartitioning\(file#\d+, block#.*\n\W*Project (\[.*\])", plan)[1]
    assert "AS bytes#" in moved and not re.search(r"[\[ ]piece#\d+[,\]]", moved), moved


@pytest.mark.parametrize("chunk", [1, 2, 16])
def test_chunks_do_not_matter(spark, tmp_path, monkeypatch, chunk):
    """Elements that cross chunks within a split are whole, and in order."""
    monkeypatch.setattr(files, "CHUNK", chunk)
    rng = random.Random(chunk)
    arrays = {f"{i}.json": [value(rng) for _ in range(rng.choice([0, 1, 2, 9, 30]))] for i in range(12)}
    for name, items in arrays.items():
        (tmp_path / name).write_text(json.dumps(items))
    for split_bytes in (37, 1 << 20):
        got = elements(spark, tmp_path, split_bytes)
        assert {k: [json.loads(v) for v in vs] for k, vs in got.items()} == {k: v for k, v in arrays.items() if v}


def test_tasks_follow_the_size_of_the_files(spark, tmp_path, monkeypatch):
    """Adaptive execution would merge what many files and splits hold into a few large tasks."""
    monkeypatch.setattr(files, "TASK_BYTES", 1 << 12, raising=False)
    for i in range(8):
        (tmp_path / f"{i}.json").write_text(json.dumps([{"a": j, "b": "x" * 9} for j in range(1000)]))
    size = sum(p.stat().st_size for p in tmp_path.iterdir())
    split = files.json_array_split(spark, str(tmp_path))
    pieces = files._pieces(spark, str(tmp_path))
    assert split.count() == 8000
    assert pieces.rdd.getNumPartitions() == 2 + size // (1 << 12)
    assert max(pieces.groupBy(*("file", "block", "chunk")).count().agg({"count": "max"}).first()) <= files.CHUNK
