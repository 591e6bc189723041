"""Variable-capacity best-fit packing of documents into sequences.

Documents are cut into pieces of at most the largest permitted length; nothing is left
out. Pieces are dealt to lanes by a hash, sorted by length, longest first, and packed
lane by lane: a piece goes to the open bin with the least room that still holds it. If
none does, the bin size is opened that costs least per word expected in it, where the
expected filling comes from the words still to come that would fit beside the piece
(known from a histogram of lengths). Once all pieces are placed, every bin shrinks to
the smallest permitted length that holds its contents.

A lane keeps the room of its open bins in memory, not their contents, and its pieces
stream through it in sorted order. The number of lanes follows the number of pieces.

Defined results: null texts and texts without a word have one piece of length 0 and no
bin; repeated rows are packed as rows of their own; the result has a row per piece.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.common import stored, word_count

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 32  # cost of a sequence beside its length, in words
LANE_PIECES = 50_000


def _fit(size: int, lengths: tuple[int, ...]) -> int:
    return lengths[bisect_left(lengths, size)]


class Lane:
    """Open bins of one lane by the room they have left."""

    def __init__(self, lengths: tuple[int, ...], remaining: list[float]):
        self.lengths = lengths
        self.remaining = remaining  # words still to come, by power of two of their piece
        self.rooms: list[tuple[int, int]] = []  # (room, bin), sorted
        self.opened = 0

    def _least_cost(self, size: int) -> int:
        best = None
        for length in self.lengths:
            room = length - size
            if room < 0:
                continue
            # Pieces that fit beside this one, shared with the bins that are open already.
            filler = sum(self.remaining[: max(0, room.bit_length() - 1)]) / (1 + len(self.rooms))
            cost = (length + OVERHEAD) / (size + min(room, filler))
            if best is None or (cost, length) < best:
                best = (cost, length)
        return best[1]

    def place(self, size: int) -> int:
        self.remaining[size.bit_length() - 1] -= size
        i = bisect_left(self.rooms, (size, -1))
        if i < len(self.rooms):
            room, number = self.rooms.pop(i)
        else:
            room, number = self._least_cost(size), self.opened
            self.opened += 1
        if room > size:
            insort(self.rooms, (room - size, number))
        return number


def pack(documents: DataFrame, lengths: tuple[int, ...] = LENGTHS, lane_pieces: int = LANE_PIECES) -> DataFrame:
    """``doc_id, piece, first_word, length, bin_id, bin_length`` for every piece.

    ``first_word`` counts from 0; ``bin_id`` is ``lane:number``.
    """
    spark = documents.sparkSession
    lengths = tuple(sorted(lengths))
    top = lengths[-1]
    sized = documents.select("doc_id", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("h"))
    pieces = sized.select("doc_id", "size", "h", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("size") - 1) / top)).cast("int"))).alias("piece"))
    first = F.col("piece").cast("bigint") * top
    pieces = pieces.select("doc_id", "h", "piece", first.alias("first_word"), F.least(F.lit(top), F.col("size") - first).alias("length"))
    pieces = stored(spark, pieces, "packing-pieces")

    # Words by power of two of the piece's length: a row per power at most.
    power = F.floor(F.log2(F.col("length"))).cast("int").alias("p")
    histogram = pieces.where("length > 0").groupBy(power).agg(F.count("*").alias("n"), F.sum("length").alias("w")).collect()
    lanes = max(1, -(-sum(r["n"] for r in histogram) // lane_pieces))
    expected = [0.0] * (top.bit_length() + 1)
    for r in histogram:
        expected[r["p"]] = r["w"] / lanes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, number = None, -1
        for batch in batches:
            bins = []
            for own, size in zip(batch["lane"], batch["length"], strict=True):
                if own != number:  # a task may hold several lanes, one after the other
                    lane, number = Lane(lengths, list(expected)), own
                bins.append(f"{own}:{lane.place(int(size))}")
            yield batch[["doc_id", "unnamed", "piece", "first_word", "length"]].assign(bin_id=bins)

    # Null ids go as 0 with a mark: beside a null, pandas would turn the others into floats.
    schema = "doc_id bigint, unnamed boolean, piece int, first_word bigint, length bigint, bin_id string"
    dealt = pieces.where("length > 0").withColumn("lane", F.pmod(F.xxhash64("doc_id", "piece", "h"), F.lit(lanes)).cast("int"))
    doc_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("doc_id")
    dealt = dealt.select("lane", doc_id, F.col("doc_id").isNull().alias("unnamed"), "piece", "first_word", "length")
    dealt = dealt.repartition(lanes, "lane").sortWithinPartitions("lane", F.desc("length"), "doc_id", "piece")
    packed = stored(spark, dealt.mapInPandas(run, schema), "packing-bins")
    packed = packed.withColumn("doc_id", F.when(~F.col("unnamed"), F.col("doc_id"))).drop("unnamed")

    content = F.sum("length").over(Window.partitionBy("bin_id"))
    shrunk = F.lit(top)
    for length in reversed(lengths):
        shrunk = F.when(F.col("content") <= length, F.lit(length)).otherwise(shrunk)
    full = packed.withColumn("content", content).withColumn("bin_length", shrunk).drop("content")
    none = pieces.where("length <= 0").select(
        "doc_id", "piece", "first_word", F.lit(0).cast("bigint").alias("length"), F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("int").alias("bin_length")
    )
    return full.unionByName(none)
