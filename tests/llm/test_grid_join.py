"""The epsilon grid order join against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystream.llm import grid_join

VECTORS = "vec_id bigint, embedding array<double>, label int"


def expected(rows, threshold=0.98):
    """n_links and component_id of each row, by position."""
    units = []
    for _, v, label in rows:
        ok = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v) / max(map(abs, v)) if ok else None)
    n, up = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                n[i] += 1
                n[j] += 1
                up[top(i)] = top(j)
    ids = {}
    for i, (vec_id, *_) in enumerate(rows):
        if vec_id is not None:
            ids[top(i)] = min(ids.get(top(i), vec_id), vec_id)
    return sorted(
        ((r[0], n[i], ids.get(top(i)), r[0] == ids.get(top(i))) for i, r in enumerate(rows)), key=str
    )


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, VECTORS)
    frame = frame.withColumns({"id": F.lit(1), "block": F.lit("x"), "weight": F.lit(2), "k1": F.lit(0)})
    df = grid_join.near_duplicates(frame, **options)
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_rows", [9, None])
def test_matches_all_pairs(spark, block_rows):
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1, 2):
        centres = rng.normal(size=(12, 20))
        for i in range(120 if label else 260):
            spread = rng.choice([0.0, 0.02, 0.05, 0.3])
            v = centres[rng.integers(12)] + rng.normal(size=20) * spread
            rows.append((len(rows) * 7 % 5003, [float(x) for x in v * rng.uniform(0.1, 9)], label))
    dense = rng.normal(size=20)
    rows += [(9000 + i, [float(x) for x in dense + rng.normal(size=20) * 0.01], 0) for i in range(150)]
    rows += [(20000 + i, [float(x) for x in dense], 0) for i in range(90)]  # copies
    rows += [(30000, [float(x) for x in dense], 1)]
    assert found(spark, rows, block_rows=block_rows) == expected(rows)


def test_awkward_rows(spark):
    v = [1.0, 2.0, 2.0]
    rows = [
        (1, v, 1), (2, [2.0, 4.0, 4.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [math.nan, 1.0, 1.0], 1), (9, [math.inf, 1.0, 1.0], 1), (10, [None, 1.0, 1.0], 1), (None, v, 1), (None, v, 1),
        (None, [5.0, -1.0, 0.0], 3), (None, None, None), (1, [-1.0, 0.0, 0.0], 1), (1, v, 1),
        (11, [1e300, 2e300, 2e300], 1), (12, [1e-300, 2e-300, 2e-300], 1),
        (13, [1.0, 2.0], 1), (14, [1.0, 2.0, 2.0, 0.0], 1), (15, [0.0, 1.0], 4), (16, [-0.0, 1.0], 4),
    ]
    got = found(spark, rows)
    want = expected(rows)
    # A row without an id is kept only where no row it reaches has one.
    assert got == sorted(((a, b, c, a == c) for a, b, c, _ in want), key=str)


def test_chain_is_one_component(spark):
    """Neighbours link, ends do not."""
    angles = np.arange(60) * 0.19  # cos 0.19 = 0.982
    rows = [(100 - i, [math.cos(a), math.sin(a)], 5) for i, a in enumerate(angles) if a < 3]
    got = found(spark, rows, block_rows=4)
    assert got == expected(rows)
    assert len({r[2] for r in got}) == 1 and max(r[1] for r in got) == 2


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, None)]) == [(1, 0, 1, True)]


def test_distant_blocks_are_skipped(spark):
    """Two far clusters of one label, sorted: only pairs of blocks inside a cluster are joined."""
    rng = np.random.default_rng(2)
    rows = []
    for side in (-1.0, 1.0):
        for _ in range(64):
            rows.append((len(rows), [float(x) for x in (side * 5 + rng.normal() * 0.1, *rng.normal(size=3) * 0.1)], 0))
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<double>, label int")
    units = grid_join.unit_rows(np.array([r[1] for r in rows]))
    order = sorted(range(len(rows)), key=lambda i: units[i][0])
    placed = [(k, k // 16, 0, [float(x) for x in units[i]] + [0.0] * (grid_join.AXES - 4)) for k, i in enumerate(order)]
    ordered = spark.createDataFrame(placed, "id bigint, block bigint, label int, place array<float>")
    pairs = {(r["i"], r["j"]) for r in grid_join.block_pairs(ordered, 8, 0.2).collect()}
    assert frame.count() == 128 and pairs == {(i, j) for i in range(8) for j in range(i, 8) if i // 4 == j // 4}


def test_two_blocks_give_few_rows():
    """A dense pair of blocks answers with one row for each vector, not one for each link."""
    rng = np.random.default_rng(4)
    units = grid_join.unit_rows(rng.normal(size=(1, 8)) + rng.normal(size=(1500, 8)) * 1e-3)
    links, roots = grid_join.join_blocks(
        units, units.astype(np.float32), np.zeros(1500, dtype=int), np.ones(1500, dtype=np.int64), 700, 0.98, 0.21
    )
    assert (links[:700] == 800).all() and (links[700:] == 700).all() and (roots == 0).all()
