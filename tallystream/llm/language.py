"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its character n-grams (one to three letters
within words, with a mark at both ends), hashed into a fixed number of buckets. A linear
softmax on the average names the language. Embeddings and weights are trained together
by stochastic gradient descent in numpy on a bounded sample; a temperature, fitted on
rows held back from it, calibrates the probabilities, and the lowest probability at
which held-back rows reach the wanted precision is the limit of rejection.

Since the average is linear, prediction looks up one row of class scores per n-gram.

Defined results: null texts and texts without a letter are ``und`` with score 0; texts
are read whole; equal texts get equal results. Without training rows all are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import bounded_sample, crc_fold

BUCKETS = 1 << 13
CHUNK = 1 << 20  # characters looked at together; memory does not grow with the text
_LETTERS = np.zeros(0x110000, dtype=bool)


def _letters() -> np.ndarray:
    """Which code points are letters; filled on first use in a process."""
    if not _LETTERS[ord("a")]:
        for first in range(0, 0x110000, 0x10000):
            if first < 0x40000:
                _LETTERS[first : first + 0x10000] = [chr(c).isalpha() for c in range(first, first + 0x10000)]
    return _LETTERS


def buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, in pieces of bounded size."""
    letters = _letters()
    step = len(text) if len(text) <= CHUNK else CHUNK
    for at in range(0, len(text), max(1, step)):
        piece = f" {text[at : at + step]} ".lower()
        points = np.frombuffer(piece.encode("utf-32-le", errors="surrogatepass"), dtype=np.uint32).astype(np.int64)
        points[~letters[points]] = 32
        points = points[np.r_[True, (points[1:] != 32) | (points[:-1] != 32)]]
        a, b, c = points[:-2], points[1:-1], points[2:]
        middle = b != 32  # n-grams are centred on a letter
        a, b, c = a[middle], b[middle], c[middle]
        one = b * 0x9E3779B1
        left = (a * 0x85EBCA6B) ^ one
        three = (left * 0x27D4EB2F) ^ (c * 0xC2B2AE3D)
        for h in (one, left, three):
            h = (h ^ (h >> 15)) * 0x2C1B3C6D
            yield ((h ^ (h >> 13)) & (BUCKETS - 1)).astype(np.int32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets x languages: embeddings times weights
    bias: np.ndarray
    temperature: float
    limit: float  # of rejection

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return "und", 0.0
        total, n = np.zeros(len(self.languages)), 0
        for ids in buckets(text):
            counts = np.bincount(ids, minlength=BUCKETS)
            total += counts @ self.scores
            n += len(ids)
        z = (total / max(1, n) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _training_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, shares, langs = [], [], []
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            if not has_letter(text):
                continue
            counts = np.zeros(BUCKETS)
            for found in buckets(text):
                counts += np.bincount(found, minlength=BUCKETS)
            own = np.flatnonzero(counts)
            ids.append(own.astype(np.int32))
            shares.append((counts[own] / counts.sum()).astype(np.float32))
            langs.append(lang)
        yield pd.DataFrame({"ids": ids, "shares": shares, "lang": langs})


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def train(
    documents: DataFrame,
    sample_rows: int = 5000,
    dims: int = 16,
    epochs: int = 25,
    rate: float = 0.5,
    precision: float = 0.99,
    seed: int = 1,
) -> Model:
    """A model from at most about ``sample_rows`` rows of four of five folds that name a language."""
    known = documents.where("lang IS NOT NULL AND text IS NOT NULL").where(crc_fold(F.col("doc_id"), 5) != 0)
    sample = bounded_sample(known.select("doc_id", "text", "lang"), "doc_id", sample_rows)
    rows = sample.select("text", "lang").mapInPandas(_training_rows, "ids array<int>, shares array<float>, lang string").toPandas()
    rows = rows.iloc[np.argsort([f"{lang} {len(i)} {float(np.sum(i)):.0f}" for lang, i in zip(rows["lang"], rows["ids"], strict=True)], kind="stable")] if len(rows) else rows
    languages = sorted(set(rows["lang"]))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    y = np.array([languages.index(x) for x in rows["lang"]])
    ids, shares = list(rows["ids"]), list(rows["shares"])
    random = np.random.default_rng(seed)
    order = random.permutation(len(y))
    held, fit = order[: len(y) // 5], order[len(y) // 5 :]
    embeddings = random.normal(0, 0.5, (BUCKETS, dims))
    weights = random.normal(0, 0.5, (dims, len(languages)))
    bias = np.zeros(len(languages))

    def dense(chosen: np.ndarray) -> np.ndarray:
        x = np.zeros((len(chosen), BUCKETS))
        for k, i in enumerate(chosen):
            x[k, ids[i]] = shares[i]
        return x

    squared = [np.full_like(embeddings, 1e-8), np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)]
    for _ in range(epochs):
        fit = random.permutation(fit)
        for at in range(0, len(fit), 64):
            batch = fit[at : at + 64]
            x = dense(batch)
            h = x @ embeddings
            p = _softmax(h @ weights + bias)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            steps = (x.T @ (p @ weights.T), h.T @ p, p.sum(0))
            for value, grad, past in zip((embeddings, weights, bias), steps, squared, strict=True):
                past += grad**2
                value -= rate * 0.2 * grad / np.sqrt(past)
    scores = embeddings @ weights

    temperature, limit = 1.0, 0.0
    if len(held):
        z = np.vstack([dense(held[k : k + 256]) @ scores for k in range(0, len(held), 256)]) + bias
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(_softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(z / temperature)
        right, top = p.argmax(1) == y[held], p.max(1)
        high = np.argsort(-top)
        good = np.cumsum(right[high]) / np.arange(1, len(high) + 1)
        reached = np.flatnonzero(good >= precision)
        limit = float(top[high[reached[-1]]]) if len(reached) else 1.0
    return Model(languages, scores, bias, temperature, limit)


def identify(text: Column, model: Model) -> Column:
    """``lang, score, rejected`` of a text column."""

    @F.pandas_udf("struct<lang:string,score:double,rejected:boolean>")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [model.predict(t) for t in texts]
        return pd.DataFrame([(lang, p, p < model.limit) for lang, p in found], columns=["lang", "score", "rejected"])

    return run(text)


def report(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` and whether calibration would reject the answer."""
    model = model or train(documents)
    found = documents.select("doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"), identify(F.col("text"), model).alias("f"))
    return found.select("doc_id", "held_out", F.col("f.lang").alias("lang_pred"), F.col("f.score").alias("score"), F.col("f.rejected").alias("rejected"))
