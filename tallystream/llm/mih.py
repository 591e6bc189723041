"""Nearest neighbours by multi-index hashing with learned rotated binary codes.

Vectors are centred, rotated to principal axes and turned by an iterative quantisation
that brings them close to the corners of a cube; signs give the code. A code is cut
into substrings of eight bits, each with an index of its own. Two codes within distance
r agree in at least one of m substrings up to floor(r / m) bits, so probing every
substring index to that distance finds every code within the radius; what is found is
ranked by the inner product of the original vectors in double precision.

Rows are hashed into blocks of bounded size, queries too, and each task handles one
pair of blocks: its index, its probes and the best rows for each query. The blocks'
answers merge in a second step. A block in which a query has too few codes within the
radius widens the radius for that query until there are enough or no rows are left.

The rotation and the radius are learned on a bounded sample; every row is indexed.

Defined results: null vectors, zero vectors, vectors with null or non-finite components
and vectors of another length than the most common one take no part; rows that repeat
id and vector count once; ties go to the smaller id; a query with fewer candidates than
asked for gets all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.common import bounded_sample

PIECE = 8  # bits of a substring


@dataclass
class Codes:
    mean: np.ndarray
    turn: np.ndarray  # dimensions x bits
    radius: int

    @property
    def bits(self) -> int:
        return self.turn.shape[1]

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Rows of bytes, one byte for each substring."""
        return np.packbits((vectors - self.mean) @ self.turn > 0, axis=1)


ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _rotation(sample: np.ndarray, bits: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    mean = sample.mean(0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    if axes.shape[1] < bits:
        axes = np.pad(axes, ((0, 0), (0, bits - axes.shape[1])))
    z = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(z @ turn > 0, 1.0, -1.0).T @ z)
        turn = (u @ w).T
    return mean, axes @ turn


def learn(sample: np.ndarray, k: int = 20, recall: float = 0.97, rounds: int = 30, seed: int = 3) -> Codes:
    """Rotation and radius. The radius covers the given share of the sample's true
    neighbours; in all rows neighbours are nearer than in a sample, so it is on the
    safe side."""
    dims = sample.shape[1]
    bits = max(PIECE, min(64, dims // PIECE * PIECE))
    mean, turn = _rotation(sample, bits, rounds, seed)
    codes = Codes(mean, turn, bits)
    probes = np.arange(0, len(sample), max(1, len(sample) // 256))[:256]
    near = sample[probes] @ sample.T
    near[np.arange(len(probes)), probes] = -np.inf
    best = np.argsort(-near, axis=1)[:, : min(k, len(sample) - 1)]
    if best.size:
        c = codes.encode(sample)
        apart = ONES[c[probes][:, None, :] ^ c[best]].sum(-1)
        codes.radius = int(np.quantile(apart, recall))
    return codes


class Index:
    """Substring indexes over one block of rows."""

    def __init__(self, codes: Codes, ids: np.ndarray, vectors: np.ndarray):
        self.codes, self.ids, self.vectors = codes, ids, vectors
        self.rows = codes.encode(vectors)
        self.order = [np.argsort(self.rows[:, j], kind="stable").astype(np.int32) for j in range(self.rows.shape[1])]
        self.starts = [np.searchsorted(self.rows[o, j], np.arange(257)) for j, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of all rows whose code is at most ``radius`` away."""
        per_piece = radius // len(code)
        masks = np.flatnonzero(ONES <= per_piece)
        seen = np.zeros(len(self.ids), dtype=bool)
        for j, value in enumerate(code):
            for probe in masks ^ int(value):
                a, b = self.starts[j][probe], self.starts[j][probe + 1]
                if a < b:
                    seen[self.order[j][a:b]] = True
        found = np.flatnonzero(seen)
        return found[ONES[self.rows[found] ^ code].sum(1) <= radius]

    def nearest(self, query_id: int, vector: np.ndarray, k: int) -> list[tuple[int, float]]:
        code = self.codes.encode(vector[None, :])[0]
        radius = self.codes.radius
        while True:
            found = self.within(code, radius)
            found = found[self.ids[found] != query_id]
            if len(found) >= k or radius >= self.codes.bits:
                break
            radius = min(self.codes.bits, radius + len(code))
        scores = (self.vectors[found] * vector).sum(1)
        if len(found) > 4 * k:  # ties at the border stay in
            border = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= border], scores[scores >= border]
        best = np.lexsort((self.ids[found], -scores))[:k]
        return [(int(self.ids[found[i]]), float(scores[i])) for i in best]


def usable(vector: Column) -> Column:
    """Vectors that take part: finite components throughout, at least one not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def search(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample_rows: int = 8192,
    block_rows: int = 65_536,
    query_rows: int = 512,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each query row."""
    spark = embeddings.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = embeddings.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return empty
    rows = rows.where(F.size("v") == sizes["d"]).dropDuplicates(["id", "v"])
    sample = bounded_sample(rows, "id", sample_rows).select("v").toPandas()["v"]
    if not len(sample):
        sample = rows.limit(1).select("v").toPandas()["v"]
    codes = learn(np.array([list(x) for x in sample]), k)

    # Rows go to every block of queries and queries to every block of rows.
    blocks = -(-sizes["count"] // block_rows)
    query_blocks = max(1, -(-rows.where("q").count() // query_rows))
    place = F.xxhash64("id", "v")
    to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.select(F.pmod(place, F.lit(blocks)).cast("int").alias("block"), to_all(query_blocks).alias("part"), "id", "v", F.lit(False).alias("q"))
    queries = rows.where("q").select(to_all(blocks).alias("block"), F.pmod(F.xxhash64(F.lit(5), "id", "v"), F.lit(query_blocks)).cast("int").alias("part"), "id", "v", F.lit(True).alias("q"))

    def answer(pairs: pd.DataFrame) -> pd.DataFrame:
        asked = pairs[pairs["q"]]
        own = pairs[~pairs["q"]]
        out: list[tuple[int, int, float]] = []
        if len(asked) and len(own):
            index = Index(codes, own["id"].to_numpy(), np.stack(own["v"].to_numpy()))
            for query, vector in zip(asked["id"], asked["v"], strict=True):
                out += [(query, i, s) for i, s in index.nearest(query, np.asarray(vector), k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = data.unionByName(queries).groupBy("block", "part").applyInPandas(answer, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
