"""Spelling variants: words one edit apart, grouped under their most frequent form.

Letters are hashed to eight symbols. For every word of the vocabulary the full one-edit
neighbourhood of its reduced form is generated (the form itself, all deletions,
replacements and insertions over the eight symbols) and joined with the reduced
vocabulary. An edit of the original is at most one edit of the reduced form, so every
pair of near words meets; what meets is verified on the original strings.

A reduced form is a polynomial hash, so each neighbour follows from prefix sums in
constant time and space, and a run of letters of any length costs its length. Equal
hashes of different forms only bring candidates that verification drops. Neighbours
are looked up in a bitmap of fixed size (8 MB) before they are shuffled: almost none
of them is a word. With vocabularies far beyond ten million words the bitmap fills and
lets more through, at no change of the result.

Defined results: a null text has no words; a null id counts as empty text in the
checksum; rows repeated by id count as often as they stand there. Words tied in count
go by code point. An empty table gives no words. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.common import lower_ascii, stored

LETTERS = r"[a-zÀ-ÿ]"
SYMBOLS = 8
SLIP = 199  # one occurrence in so many loses a letter
MIN_LETTERS, MIN_COUNT, DOMINANCE = 6, 5, 5

BITMAP_BITS = 1 << 26
CELLS = 1 << 20  # hashes made at once

# Any odd numbers do; a reduced form is sum(VALUE[symbol] * BASE^place) modulo 2^64.
_DRAW = np.random.Generator(np.random.PCG64(11))
VALUE = _DRAW.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BACK = np.uint64(pow(BASE, -1, 1 << 64))
LENGTH = 0xD1B54A32D192ED03


def word_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least six letters found at least five times.

    Runs of fewer letters cannot give such a word, so the pattern leaves them out; a
    shorter match inside a run cannot start before the run itself.
    """
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    runs = F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{MIN_LETTERS},}}"), F.lit(0))
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    # Equal runs of a text share their checksum, but few repeat: counting per text first
    # would only add a grouping.
    words = documents.select(key.alias("key"), F.explode(runs).alias("run"))
    words = words.select("run", F.crc32(F.concat("key", "run")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    slipped = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word = F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run"))
    counted = words.select(word.alias("word")).where(F.char_length("word") >= MIN_LETTERS)
    return counted.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def symbols(points: np.ndarray) -> np.ndarray:
    """The symbol of each code point, an even hash."""
    mixed = points.astype(np.uint64) * np.uint64(0x9E3779B1)
    return ((mixed >> np.uint64(15)) % np.uint64(SYMBOLS)).astype(np.int64)


def _of_length(n: int) -> np.uint64:
    return np.uint64(n * LENGTH % (1 << 64))


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, dtype=np.uint64)
    if n:
        out[1:] = np.cumprod(np.full(n, BASE, dtype=np.uint64))
    return out


def _by_length(words: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of words of one length, with their symbols as a matrix; few at once."""
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, CELLS // (int(length) * 2 * SYMBOLS + 1))
        for i in range(0, len(rows), step):
            part = rows[i:i + step]
            text = "".join(words.iloc[part])
            points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
            yield part, symbols(points).reshape(len(part), int(length))


def reduced(words: pd.Series) -> np.ndarray:
    """The hash of each word's reduced form."""
    out = np.zeros(len(words), dtype=np.uint64)
    for rows, sym in _by_length(words):
        power = _powers(sym.shape[1])
        out[rows] = (VALUE[sym] * power[:-1]).sum(1, dtype=np.uint64) + _of_length(sym.shape[1])
    return out.view(np.int64)


def neighbours(sym: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of all forms at most one edit from each row of symbols, by kind of edit."""
    n, length = sym.shape
    power = _powers(length)
    shorter, same, longer = (_of_length(length + d) for d in (-1, 0, 1))
    terms = VALUE[sym] * power[:-1]
    before = np.zeros((n, length + 1), dtype=np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    yield whole + same
    yield before[:, :-1] + (whole - before[:, 1:]) * BACK + shorter
    shifted = before + (whole - before) * np.uint64(BASE) + longer
    for symbol in range(SYMBOLS):
        yield whole - terms + VALUE[symbol] * power[:-1] + same
        yield shifted + VALUE[symbol] * power


def _own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(own=reduced(batch["word"]))


def _hits(bitmap: np.ndarray):
    """Neighbours that the bitmap has, each once per word."""
    low = np.uint64(BITMAP_BITS - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows, sym in _by_length(batch["word"]):
                at, found = [], []
                for hashes in neighbours(sym):
                    bit = hashes & low
                    known = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
                    r, c = np.nonzero(known)
                    at.append(rows[r])
                    found.append(hashes[r, c].view(np.int64))
                hit = pd.DataFrame({"row": np.concatenate(at), "target": np.concatenate(found)}).drop_duplicates()
                source = batch.iloc[hit["row"].to_numpy()]
                yield pd.DataFrame({
                    "word": source["word"].to_numpy(), "n": source["n"].to_numpy(), "target": hit["target"].to_numpy(),
                })

    return run


def _bitmap(vocabulary: DataFrame) -> np.ndarray:
    """One bit for each low part of a reduced form; at most 2,048 rows of 4 KB are fetched."""
    bit = F.col("own").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1
    parts = vocabulary.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():
        start = (row["bucket"] - 1) * 4096  # numbers from 1, 32768 in a bucket
        out[start:start + 4096] |= np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def near_pairs(spark: SparkSession, vocabulary: DataFrame) -> DataFrame:
    """``word, n, other, other_n`` for all words of ``vocabulary(word, n, own)`` exactly one edit apart,
    each pair in both directions."""
    hits = vocabulary.select("word", "n").mapInPandas(_hits(_bitmap(vocabulary)), "word string, n bigint, target bigint")
    others = vocabulary.select(F.col("own").alias("target"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = shuffled(hits).join(others, "target").where(F.col("word") != F.col("other"))
    return met.where(one_edit(F.col("word"), F.col("other"))).select("word", "n", "other", "other_n")


def shuffled(rows: DataFrame) -> DataFrame:
    """The rows, joined by a shuffle of both sides whatever size Spark expects.

    It takes what Python makes of a table to be as large as the table, and a table to be as
    large as its compressed files, so either may be sent to the driver at many times the limit.
    """
    return rows.hint("merge")


def one_edit(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each chain of forms. Counts grow fivefold along a chain, so it is
    short; every round doubles the steps taken."""
    held = stored(spark, forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = shuffled(held).join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = stored(spark, moved, "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        held = moved.select("word", "root")


def variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the corpus.

    ``form`` is the most frequent near word if it stands at least five times as often,
    ``root`` the end of the chain of forms.
    """
    spark = documents.sparkSession
    counts = word_counts(documents, id_col, text_col)
    vocabulary = stored(spark, counts.mapInPandas(_own, "word string, n bigint, own bigint"), "spelling-words")
    near = near_pairs(spark, vocabulary)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best")
    near = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.less")
    strong = form_n >= DOMINANCE * F.col("n")
    near = near.select(
        "word", "n_near", F.when(strong, F.col("best.other")).alias("form"), F.when(strong, form_n).alias("form_n")
    )
    near = stored(spark, near, "spelling-near")
    roots = _roots(spark, near.where("form IS NOT NULL"))
    out = vocabulary.join(shuffled(near), "word", "left").join(shuffled(roots), "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"),
        "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n",
    )
