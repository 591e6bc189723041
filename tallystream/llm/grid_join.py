"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with a cosine of at least t lie within epsilon = sqrt(2 - 2t) of each other,
and so do their projections on any orthonormal directions. The vectors are projected on
their leading principal directions, cut into grid cells of side epsilon and sorted by
label and cells. The sequence is cut into blocks of bounded size, blocks into intervals
of eight, and so on up to the whole. Intervals are joined recursively from the top, by
Spark joins on the intervals' numbers: a pair of intervals with different labels, or with
boxes further apart than epsilon, is skipped with everything below it. The pairs of
blocks left are joined each in a task of its own, by the same recursion down to a few
hundred rows and there by a matrix product in double precision.

No step lists the pairs of a group: a pair of blocks gives, for each of its vectors, the
number of links and one edge of a spanning forest. Equal vectors of a label are one
vector with a weight. A hot label or group of near copies is many blocks, spread over
the tasks.

The directions are fitted on a bounded sample (``SAMPLE`` vectors); any directions give
the same result, better ones skip more. Where vectors spread evenly in many dimensions
little can be skipped, and the work grows with the square of the largest label.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and vectors without a label, link with nothing. Vectors of different lengths
do not link. Rows that repeat an id stay rows of their own; equal vectors link. A row
without an id takes the component of the rows it links with and has none if there are
none with an id; it is kept only if it has none. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.common import bounded_sample, stored
from tallystream.llm.jaccard import components
from tallystream.operators.ordering import with_ordinal

THRESHOLD = 0.98
SAMPLE = 8192
AXES = 16  # principal directions kept; the first GRID of them order the sequence
GRID = 8
FAN = 8  # intervals in the next larger one
BLOCK_BYTES = 1 << 20
LEAF = 256
SLACK = 1e-4  # projections are kept in single precision

EDGES = "id bigint, links bigint, root bigint"


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision and safe from overflow."""
    scaled = vectors.astype(np.float64)
    scaled /= np.abs(scaled).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def principal_axes(sample: pd.DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors, the directions in which those of one label differ most."""
    out = {}
    for dim, part in sample.groupby(sample["vector"].str.len()):
        units = unit_rows(np.stack(part["vector"].to_numpy()))
        codes, _ = pd.factorize(part["label"])
        means = np.zeros((codes.max() + 1, dim))
        np.add.at(means, codes, units)
        centred = units - (means / np.bincount(codes)[:, None])[codes]
        _, axes = np.linalg.eigh(centred.T @ centred)
        out[int(dim)] = axes[:, ::-1][:, :AXES]
    return out


def _project(axes: dict[int, np.ndarray], epsilon: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = np.zeros((len(batch), AXES), dtype=np.float32)
            sizes = batch["vector"].str.len().to_numpy()
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                units = unit_rows(np.stack(batch["vector"].iloc[rows].to_numpy()))
                turn = axes.get(int(dim), np.eye(int(dim), AXES))
                places[rows[:, None], np.arange(turn.shape[1])] = units @ turn
            cells = np.floor(places[:, :GRID] / epsilon).astype(np.int32)
            yield batch.assign(place=list(places), cells=list(cells))

    return run


# In a task: two blocks

class Forest:
    """Components of the vectors of two blocks, by the least number in each."""

    def __init__(self, size: int):
        self.up = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.up[a], self.up[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.up[self.up]
                if (up == self.up).all():
                    break
                self.up = up


def _apart(low_a, high_a, low_b, high_b, reach: float) -> bool:
    gap = np.maximum(np.maximum(low_b - high_a, low_a - high_b), 0)
    return float((gap * gap).sum()) > reach * reach


def join_blocks(units, places, labels, weights, first: int, threshold: float, reach: float):
    """Links and roots for the vectors of one or two sorted blocks, as one sequence.

    The first ``first`` vectors are one block, the rest the other; without a rest the
    block is joined with itself, else only vectors of different blocks are.
    """
    size = len(labels)
    links, forest = np.zeros(size, dtype=np.int64), Forest(size)
    itself = first == size
    todo = [(0, first, 0, first) if itself else (0, first, first, size)]
    while todo:
        a, a2, b, b2 = todo.pop()
        if labels[a] > labels[b2 - 1] or labels[b] > labels[a2 - 1]:
            continue
        box = [f(places[i:k], axis=0) for i, k in ((a, a2), (b, b2)) for f in (np.min, np.max)]
        if _apart(*box, reach):
            continue
        if max(a2 - a, b2 - b) > LEAF:
            if itself and a == b and a2 == b2:
                m = (a + a2) // 2
                todo += [(a, m, a, m), (a, m, m, a2), (m, a2, m, a2)]
            elif a2 - a >= b2 - b:
                m = (a + a2) // 2
                todo += [(a, m, b, b2), (m, a2, b, b2)]
            else:
                m = (b + b2) // 2
                todo += [(a, a2, b, m), (a, a2, m, b2)]
            continue
        hit = units[a:a2] @ units[b:b2].T >= threshold
        hit &= labels[a:a2, None] == labels[None, b:b2]
        if a == b:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        links[a:a2] += hit @ weights[b:b2]
        if a != b:
            links[b:b2] += weights[a:a2] @ hit
        r, c = np.nonzero(hit)
        forest.link(r + a, c + b)
    return links, forest.up


def _joined(threshold: float, reach: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", ignore_index=True)
        sizes = rows["vector"].str.len()
        out = []
        for _, part in rows.groupby(sizes):  # vectors of one length
            ids = part["id"].to_numpy()
            first = int((part["block"] == part["i"]).sum())
            if part["i"].iloc[0] != part["j"].iloc[0] and first in (0, len(ids)):
                continue
            links, roots = join_blocks(
                unit_rows(np.stack(part["vector"].to_numpy())), np.stack(part["place"].to_numpy()),
                part["label"].to_numpy(), part["weight"].to_numpy(), first, threshold, reach,
            )
            found = np.flatnonzero(links)
            out.append(pd.DataFrame({"id": ids[found], "links": links[found], "root": ids[roots[found]]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "links": [], "root": []}, dtype="int64")

    return run


# Over the cluster: intervals of blocks

def _boxes(blocks: DataFrame, width: int) -> DataFrame:
    """Bounds of the intervals of ``width`` blocks."""
    sides = [f(F.col(c)[k]).alias(f"{c}{k}") for c, f in (("low", F.min), ("high", F.max)) for k in range(AXES)]
    node = F.floor(F.col("block") / width).cast("bigint").alias("node")
    edges = F.min("from_label").alias("from_label"), F.max("to_label").alias("to_label")
    boxes = blocks.groupBy(node).agg(*edges, *sides)
    corners = (F.array(*(f"{c}{k}" for k in range(AXES))).alias(c) for c in ("low", "high"))
    return boxes.select("node", "from_label", "to_label", *corners)


def block_pairs(ordered: DataFrame, blocks: int, reach: float) -> DataFrame:
    """``i, j`` (i <= j) of the blocks that may hold near vectors, by descent through the intervals."""
    spark = ordered.sparkSession
    first = ordered.select("block", F.col("label").alias("from_label"), F.col("label").alias("to_label"),
                           F.col("place").alias("low"), F.col("place").alias("high"))
    boxes = stored(spark, _boxes(first, 1), "grid-boxes").withColumnRenamed("node", "block")
    width = 1
    while width < blocks:
        width *= FAN
    pairs = spark.range(1).select(F.col("id").alias("i"), F.col("id").alias("j"))
    while width > 1:
        width //= FAN
        level = _boxes(boxes, width)
        a = level.select(F.col("node").alias("i"), F.struct("*").alias("a"))
        b = level.select(F.col("node").alias("j"), F.struct("*").alias("b"))
        for end in ("i", "j"):
            under = F.sequence(F.col(end) * FAN, F.col(end) * FAN + (FAN - 1))
            pairs = pairs.withColumn(end, F.explode(under))
        gaps = F.zip_with(
            F.arrays_zip(F.col("a.low").alias("low"), F.col("a.high").alias("high")),
            F.arrays_zip(F.col("b.low").alias("low"), F.col("b.high").alias("high")),
            lambda x, y: F.greatest(F.lit(0.0), y["low"] - x["high"], x["low"] - y["high"]).cast("double"),
        )
        near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= reach * reach
        met = pairs.where("i <= j").join(a, "i").join(b, "j")
        same = (F.col("a.from_label") <= F.col("b.to_label")) & (F.col("b.from_label") <= F.col("a.to_label"))
        pairs = stored(spark, met.where(same & near).select("i", "j"), "grid-pairs")
    return pairs


def near_duplicates(
    embeddings: DataFrame, threshold: float = THRESHOLD,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    block_rows: int | None = None,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row, by links of cosine >= ``threshold``
    between vectors of one label."""
    spark = embeddings.sparkSession
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    reach = epsilon + SLACK

    fit = F.col(label_col).isNotNull() & usable(F.col(vector_col))
    key = F.xxhash64("label", "vector").alias("k1"), F.xxhash64(F.lit(1), "label", "vector").alias("k2")
    rows = embeddings.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"),
        F.coalesce(fit, F.lit(False)).alias("fit"),
    )
    keyed = rows.where("fit").select("vec_id", "label", "vector", *key)
    groups = keyed.groupBy("k1", "k2", "label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    groups = stored(spark, groups, "grid-vectors")
    size, dim = groups.agg(F.count("*"), F.max(F.size("vector"))).first()
    alone = rows.where("NOT fit").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not size:
        return _with_kept(alone, id_col)

    axes = principal_axes(bounded_sample(groups, "k1", SAMPLE).select("label", "vector").toPandas())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema.fields)
    placed = groups.mapInPandas(_project(axes, epsilon), f"{schema}, place array<float>, cells array<int>")
    placed = stored(spark, placed, "grid-places")
    order = "label", F.size("vector"), *(F.col("cells")[k] for k in range(GRID))
    block_rows = block_rows or max(LEAF, BLOCK_BYTES // (4 * dim))
    ordered = with_ordinal(placed, *order, name="id")
    ordered = stored(spark, ordered.withColumn("block", F.expr(f"id div {block_rows}")).drop("cells"), "grid-order")

    pairs = block_pairs(ordered, -(-size // block_rows), reach)
    side = ordered.select("id", "block", "label", "vector", "place", "weight")
    both = side.join(pairs, side["block"] == pairs["i"]).unionByName(
        side.join(pairs.where("i <> j"), side["block"] == F.col("j"))
    )
    linked = both.groupBy("i", "j").applyInPandas(_joined(threshold, reach), EDGES)
    linked = stored(spark, linked, "grid-links")

    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    edges = linked.where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v"))
    roots = components(spark, edges).select(F.col("node").alias("id"), "root")
    vectors = ordered.select("id", "k1", "k2", "least", "weight").join(counts, "id", "left").join(roots, "id", "left")
    vectors = vectors.select(
        "k1", "k2", "least", F.coalesce("root", "id").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    # Hot components: their least id combines before it moves, and the join is by size.
    least = vectors.groupBy("root").agg(F.min("least").alias("component_id"))
    vectors = vectors.join(least, "root").select("k1", "k2", "n_links", "component_id")
    found = keyed.select("vec_id", "k1", "k2").join(vectors, ["k1", "k2"]).drop("k1", "k2")
    return _with_kept(found.unionByName(alone), id_col)


def _with_kept(rows: DataFrame, id_col: str) -> DataFrame:
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    return rows.select(F.col("vec_id").alias(id_col), "n_links", "component_id", kept)
