"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Folding undoes disguises: letters of other alphabets that look Latin, accents, full
width forms, digits and signs in place of letters. The lexicon holds word beginnings
and whole words that labelled texts show to be toxic, weighted by smoothed log odds.
A hit counts unless it lies in an exception phrase, a pair of neighbouring words that
occurs mostly in clean texts. The weighted hits, normalised by the number of words, go
through a logistic curve fitted on the labels.

Evidence is counted over distinct contexts (the word with both neighbours), so that a
thousand copies of a text count once. How much of it a term needs is chosen by the
likelihood of labels held out in three folds of the rows learned from.

Defined results: null and empty texts score as texts without a hit; every text is
scored whole; equal texts score equally. Without labelled toxic rows the lexicon is
empty and all texts score the same.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import SMALL_BATCHES, bounded_sample, crc_fold
from tallystream.workspace import settings

# Signs read as the letters they resemble.
LOOKALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l",
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ł": "l", "ø": "o", "ß": "ss",
}
# Invisible characters that may split a word.
INVISIBLE = "­​‌‍⁠﻿"
WORD = re.compile(r"\w+")


class _Fold(dict):
    """A translation table filled as characters come up."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        if char in INVISIBLE:
            out = ""
        else:
            plain = unicodedata.normalize("NFKD", char).lower()
            plain = "".join(c for c in plain if not unicodedata.combining(c))
            out = "".join(LOOKALIKES.get(c, c) for c in plain)
        if len(self) < 100_000:
            self[point] = out
        return out


FOLD = _Fold()
# Signs mean letters only inside words, so they are folded only beside a letter or digit.
# Before a word they may be either: both readings are tried.
LEADING = re.compile(r"(?<![^\W_])[!|]+(?=[^\W_])")
SIGN = re.compile(r"[!|@$]+(?![^\W_])")


def tokens(text: str, leading: bool = False) -> list[str]:
    """The folded words; signs before a word are letters of it with ``leading``."""
    text = SIGN.sub(" ", text)
    return WORD.findall((text if leading else LEADING.sub(" ", text)).translate(FOLD))


SHORTEST, LONGEST = 3, 7  # letters of a word beginning


def terms_of(word: str) -> Iterator[str]:
    """Beginnings of a word and, marked by an end sign, the word itself."""
    for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
        yield word[:n]
    if SHORTEST <= len(word) <= 40:
        yield word + "$"


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[tuple[str, str]] = frozenset()
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)  # intercept, slope of density, slope of total


def automaton(weights: dict[str, float]) -> ahocorasick.Automaton | None:
    """Terms as strings that begin with a space: they match at word beginnings only."""
    if not weights:
        return None
    machine = ahocorasick.Automaton()
    for term, w in weights.items():
        whole = term.endswith("$")
        key = " " + (term[:-1] + " " if whole else term)
        machine.add_word(key, (w, len(key), whole))
    machine.make_automaton()
    return machine


def hits(text: str, machine: ahocorasick.Automaton | None, exceptions: frozenset) -> tuple[float, int, list[tuple[int, float]]]:
    """Total weight, number of words, and (place, weight) of the words hit in folded text, by
    the reading that hits more."""
    found = _hits(tokens(text), machine, exceptions)
    if machine is not None and LEADING.search(text):
        found = max(found, _hits(tokens(text, leading=True), machine, exceptions), key=lambda f: f[0])
    return found


def _hits(words: list[str], machine: ahocorasick.Automaton | None, exceptions: frozenset) -> tuple[float, int, list[tuple[int, float]]]:
    if machine is None or not words:
        return 0.0, len(words), []
    line = " " + " ".join(words) + " "
    best: dict[int, float] = {}
    for end, (w, length, _) in machine.iter(line):
        start = end - length + 1  # of the space before the word
        best[start] = max(best.get(start, 0.0), w)
    if not best:
        return 0.0, len(words), []
    kept = []
    for start in sorted(best):
        stop = line.index(" ", start + 1)
        word = line[start + 1 : stop]
        if exceptions:
            before = line[line.rfind(" ", 0, start) + 1 : start] if start else ""
            after = line[stop + 1 : line.find(" ", stop + 1)] if stop + 1 < len(line) else ""
            if (before, word) in exceptions or (word, after) in exceptions:
                continue
        kept.append((start, best[start]))
    return sum(w for _, w in kept), len(words), kept


def signals(total: float, n_words: int) -> tuple[float, float]:
    """Density (weight per hundred words, softened for short texts) and total weight, in logs."""
    return float(np.log1p(100.0 * total / (n_words + 10))), float(np.log1p(total))


def score_text(text: str | None, lexicon: Lexicon, machine) -> float:
    total, n, _ = hits(text or "", machine, lexicon.exceptions)
    density, weight = signals(total, n)
    c = lexicon.curve
    return float(1 / (1 + np.exp(-np.clip(c[0] + c[1] * density + c[2] * weight, -40, 40))))


def score(text: Column, lexicon: Lexicon) -> Column:
    """The score of a text column, from 0 to 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = automaton(lexicon.weights)
        for texts in batches:
            yield pd.Series([score_text(t, lexicon, machine) for t in texts], dtype="float64")

    return run(text)


# Training


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    clean, toxic = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"], strict=True):
            found = {t for w in set(tokens(text)) for t in terms_of(w)}
            (toxic if label else clean).update(found)
    found = [(t, clean[t], n) for t, n in toxic.items()]
    found += [(t, n, 0) for t, n in clean.items() if t not in toxic]
    yield pd.DataFrame(found, columns=["term", "clean", "toxic"])


def _contexts(candidates: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = set()
            for text, label, fold in zip(batch["text"], batch["toxic"], batch["fold"], strict=True):
                words = ["", *tokens(text), ""]
                for i in range(1, len(words) - 1):
                    for t in terms_of(words[i]):
                        if t in candidates:
                            rows.add((t, words[i - 1], words[i], words[i + 1], int(label), int(fold)))
            yield pd.DataFrame(list(rows), columns=["term", "before", "word", "after", "toxic", "fold"])

    return run


def _odds(toxic: float, clean: float, share: float) -> float:
    """Log odds of a term against the share of toxic texts, smoothed."""
    return float(np.log((toxic + 0.5) / (clean + 0.5)) - np.log((share + 1e-9) / (1 - share + 1e-9)))


def _evidence(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Twice the log likelihood ratio of a term's own toxic share to the overall one."""
    n = toxic + clean
    p = toxic / n
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(toxic > 0, toxic * np.log(p / share), 0) + np.where(clean > 0, clean * np.log((1 - p) / (1 - share)), 0)
    return np.where(p > share, 2 * g, 0)


LEAST_WEIGHT = 3.0


def _without_repeats(scored: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Weights of the most telling terms, from (toxic contexts, weight) of each.

    A beginning gives way to a longer one that has nearly all its toxic contexts, and a
    longer one to a beginning that is kept and weighs as much.
    """
    widest: dict[str, float] = {}  # by stem: most toxic contexts of any extension
    for term, (n, _) in scored.items():
        stem, whole = term.rstrip("$"), term.endswith("$")
        for k in range(SHORTEST, len(stem) + (1 if whole else 0)):
            widest[stem[:k]] = max(widest.get(stem[:k], 0.0), n)
    kept: dict[str, float] = {}
    for term in sorted(scored, key=lambda t: (len(t.rstrip("$")), t)):
        n, w = scored[term]
        stem = term.rstrip("$")
        if w < LEAST_WEIGHT or (term == stem and widest.get(stem, 0.0) >= 0.95 * n):
            continue
        if max((kept[stem[:k]] for k in range(SHORTEST, len(stem) + 1) if stem[:k] in kept), default=-1.0) < w - 0.5:
            kept[term] = w
    return kept


def _fit_curve(points: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small penalty; slopes are not negative."""
    x = np.column_stack([np.ones(len(points)), points])
    beta = np.array([-2.0, 0.5, 0.5])
    penalty = np.array([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - labels) + penalty * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-6)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(max(beta[1], 0)), float(max(beta[2], 0))


FOLDS = 3
CUTS = (24.0, 16.0, 12.0, 8.0)  # least evidence of a term, one of which cross-validation chooses


def _terms(found: pd.DataFrame, k: int, cut: float, share: float) -> dict[str, float]:
    """Weights of the terms with enough evidence in the contexts outside fold ``k`` (``FOLDS``: in all)."""
    toxic, clean = found[f"toxic{k}"].to_numpy(float), found[f"clean{k}"].to_numpy(float)
    g = _evidence(np.maximum(toxic, 1e-9), clean, share)
    scored = {
        term: (t, _odds(t, c, share))
        for term, t, c, e in zip(found["term"], toxic, clean, g, strict=True)
        if e >= cut and t >= 5 and t * (1 - share) > 4 * c * share
    }
    return _without_repeats(scored)


def _signals_udf(lexicons: list[list[Lexicon]]):
    """For a text of fold k the signals of every lexicon of ``lexicons[k]``, as one flat list."""

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        machines = [[automaton(x.weights) for x in own] for own in lexicons]
        for texts, folds in batches:
            yield pd.Series([
                [v for x, m in zip(lexicons[k], machines[k], strict=True) for v in signals(*hits(t, m, x.exceptions)[:2])]
                for t, k in zip(texts, folds, strict=True)
            ])

    return measured


def _best_cut(rows: DataFrame, found: pd.DataFrame, share: float, cuts: tuple[float, ...]) -> float:
    """The cut whose lexicons, each learned without a fold, give that fold's labels the highest likelihood."""
    lexicons = [[Lexicon(_terms(found, k, cut, share)) for cut in cuts] for k in range(FOLDS)]
    held = rows.select(_signals_udf(lexicons)("text", "fold").alias("s"), "fold", "toxic").toPandas()
    points, fold, toxic = np.stack(held["s"].to_numpy()), held["fold"].to_numpy(), held["toxic"].to_numpy(float)
    losses = []
    for i in range(len(cuts)):
        x, loss = points[:, 2 * i : 2 * i + 2], 0.0
        for k in range(FOLDS):
            own = fold == k
            if own.any() and not own.all():
                c = _fit_curve(x[~own], toxic[~own])
                p = 1 / (1 + np.exp(-np.clip(c[0] + x[own] @ np.array(c[1:]), -30, 30)))
                loss -= float(np.where(toxic[own] > 0, np.log(p), np.log1p(-p)).sum())
        losses.append(loss)
    return cuts[int(np.argmin(losses))]


def learn(documents: DataFrame, labels: DataFrame, **options) -> Lexicon:
    """The lexicon of ``learn_lexicon``, with small batches while it is learned."""
    with settings(documents.sparkSession, SMALL_BATCHES):
        return learn_lexicon(documents, labels, **options)


def learn_lexicon(
    documents: DataFrame,
    labels: DataFrame,
    sample_rows: int = 12_000,
    max_terms: int = 20_000,
    cuts: tuple[float, ...] = CUTS,
    phrases: tuple[tuple[str, str], ...] = (),
) -> Lexicon:
    """The lexicon from at most about ``sample_rows`` labelled rows of two of three folds.

    ``phrases`` are exception phrases to know beforehand, as pairs of folded words.
    """
    known = labels.where("toxic IS NOT NULL").select("doc_id", "toxic").where(crc_fold(F.col("doc_id"), 3) != 1).dropDuplicates(["doc_id"])
    chosen = bounded_sample(known, "doc_id", sample_rows)
    rows = documents.where("text IS NOT NULL").select("doc_id", "text").join(chosen, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    rows = rows.groupBy("text").agg(F.max("toxic").alias("toxic"))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))

    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if not 0 < share < 1:
        return Lexicon(exceptions=frozenset(phrases))
    counts = rows.mapInPandas(_document_counts, "term string, clean bigint, toxic bigint").groupBy("term")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    strong = counts.where((F.col("toxic") >= 4) & (F.col("toxic") * (1 - share) > 4 * F.col("clean") * share))
    found = strong.orderBy(F.desc(F.col("toxic") - F.col("clean")), "term").limit(max_terms).toPandas()
    g = _evidence(found["toxic"].to_numpy(float), found["clean"].to_numpy(float), share)
    candidates = frozenset(found["term"][g >= min(cuts)])
    if not candidates:
        return Lexicon(exceptions=frozenset(phrases))

    contexts = rows.mapInPandas(_contexts(candidates), "term string, before string, word string, after string, toxic int, fold int")
    seen = lambda toxic: F.bit_or(F.when(F.col("toxic") == toxic, F.expr("shiftleft(1, fold)")).otherwise(0))
    contexts = contexts.groupBy("term", "before", "word", "after").agg(seen(1).alias("t"), seen(0).alias("c"))
    without = lambda c, k: F.count_if(F.col(c).bitwiseAND(F.lit(~(1 << k))) != 0)
    by_term = contexts.groupBy("term").agg(
        *(without(c, k).alias(f"{name}{k}") for k in range(FOLDS + 1) for c, name in (("t", "toxic"), ("c", "clean")))
    ).toPandas()
    weights = _terms(by_term, FOLDS, _best_cut(rows, by_term, share, cuts), share)

    contexts = contexts.select("term", "before", "word", "after", *((F.col(c) > 0).cast("int").alias(c) for c in "tc"))
    # From an Arrow table: rows of a list would start Python workers of another kind, which stay.
    kept = rows.sparkSession.createDataFrame(pa.table({"term": pa.array(list(weights), pa.string())}))
    pairs = contexts.join(kept, "term", "left_semi")
    either = pairs.select("before", "word", "after", "t", "c").distinct()
    both = either.select(F.col("before").alias("x"), F.col("word").alias("y"), "t", "c").unionByName(
        either.select(F.col("word").alias("x"), F.col("after").alias("y"), "t", "c")
    )
    clean = both.where("x <> '' AND y <> ''").groupBy("x", "y").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    rules = clean.where("c >= 3 AND c > 9 * t").orderBy(F.desc(F.col("c") - F.col("t")), "x", "y").limit(max_terms).collect()
    exceptions = frozenset([*phrases, *((r["x"], r["y"]) for r in rules)])

    everyone = _signals_udf([[Lexicon(weights, exceptions)]])
    points = rows.select(everyone("text", F.lit(0)).alias("s"), "toxic").toPandas()
    curve = _fit_curve(np.stack(points["s"].to_numpy()), points["toxic"].to_numpy(float))
    return Lexicon(weights, exceptions, curve)


THRESHOLD = 0.7


def report(documents: DataFrame, labels: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    lexicon = lexicon or learn(documents, labels)
    scored = documents.select("doc_id", (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), score(F.col("text"), lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with their columns."""
    return documents.where(score(F.col("text"), learn(documents, labels)) < THRESHOLD)
