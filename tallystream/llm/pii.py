"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans. A field over the mentions of a document (runs of
digits, words with digits or ``@``, words that repeat a mailbox name) then adds
spans: neighbours share chain potentials, distant mentions with the same or a
similar key share skip potentials, and loopy message passing settles the labels of
all of them together. Words that are no mention are clamped to "none": they are
evidence, not variables, which keeps the field small in texts of any length.

Potentials are trained on a bounded sample of documents that patterns have labelled.
Node and skip weights maximise the pseudo-likelihood: each label given the features of
its mention and the labels of its skip neighbours. Mentions that share a key with a base
span have no known label and are left out; in their place every base span lends copies in
weaker forms, which are of its kind beside it and none alone. Chain potentials are
smoothed log ratios of label pairs.

Defined results: null and empty texts have no spans; every text is searched whole;
a row gets a result of its own, repeated rows equal ones.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import bounded_sample

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# What makes a word a mention, and a number written with separators.
HINT = re.compile(r"[0-9@]")
NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20.()-]{0,2}[0-9]){0,30}+")
MOST_DIGITS = 19  # of one number; more are several, each word for itself
WORD = re.compile(r"\S+")
EDGE = ".,;:!?\"'()[]{}<>"

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each ``@``: time linear even in long runs without one."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end, "email"
            at = text.find("@", end)
        else:
            end = max(end, at + 1)
            at = text.find("@", at + 1)


def base_spans(text: str | None) -> list[Span]:
    """Pattern matches by start, then kind as listed."""
    if not text:
        return []
    spans = list(_emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = digits_of(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                spans.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                spans.append((m.start(), m.end(), "phone"))
    return sort_spans(spans)


def sort_spans(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# Mentions of a document, the variables of the field


@dataclass
class Mention:
    start: int
    end: int
    text: str
    label: int  # of the base span it covers, else 0
    fixed: bool


def _hinted(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Words with a digit or ``@`` and numbers over several words, outside the taken places."""
    at, k = 0, 0
    while hint := HINT.search(text, at):
        p = hint.start()
        while taken[k][1] <= p:
            k += 1
        if p >= taken[k][0]:
            at = taken[k][1]
            continue
        start = p
        while start > at and not text[start - 1].isspace():
            start -= 1
        number = NUMBER.match(text, start, taken[k][0])
        end = WORD.match(text, start, taken[k][0]).end()
        if number and len(digits_of(number[0])) <= MOST_DIGITS and (number.end() >= end or not text[number.end() : end].strip(EDGE)):
            end = number.end()
        if k and start < taken[k - 1][1]:
            start = taken[k - 1][1]
        at = max(p + 1, min(end, taken[k][0]))
        yield start, at


def _named(text: str, names: set[str]) -> Iterator[tuple[int, int]]:
    for m in WORD.finditer(text):
        if m[0].strip(EDGE).lower() in names:
            yield m.start(), m.end()


def mentions(text: str, spans: list[Span]) -> list[Mention]:
    """Base spans, loose numbers, words with a digit or ``@``, words that repeat a mailbox name."""
    fixed: list[Mention] = []
    for start, end, kind in spans:
        if not fixed or start >= fixed[-1].end:
            fixed.append(Mention(start, end, text[start:end], LABELS.index(kind), True))
    taken = [(m.start, m.end) for m in fixed] + [(len(text) + 1, len(text) + 1)]
    names = {m.text.split("@")[0].lower() for m in fixed if m.label == 1}
    names = {n for n in names if len(n) >= 5}
    loose = list(_hinted(text, taken))
    if names:
        loose = sorted({*loose, *_named(text, names)})
    found = list(fixed)
    for start, end in loose:
        while end > start and text[end - 1] in EDGE:
            end -= 1
        while start < end and text[start] in EDGE and text[start] != "(":
            start += 1
        if start < end:
            found.append(Mention(start, end, text[start:end], 0, False))
    found.sort(key=lambda m: (m.start, not m.fixed))
    kept: list[Mention] = []
    for m in found:
        if not kept or m.start >= kept[-1].end:
            kept.append(m)
        elif m.fixed:
            kept[-1] = m
    return kept


N_FEATURES = 4096


def _shape(text: str) -> str:
    out = []
    for c in text[:40]:
        kind = "9" if c.isdigit() else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _slot(feature: str) -> int:
    return int.from_bytes(hashlib.blake2b(feature.encode(errors="surrogatepass"), digest_size=4).digest(), "little") % N_FEATURES


def features(m: Mention, text: str) -> list[int]:
    """Hashed features: shape, digits, checks and the neighbouring characters."""
    d = digits_of(m.text)
    before, after = text[max(0, m.start - 2) : m.start], text[m.end : m.end + 2]
    parts = m.text.split(".")
    names = [
        "bias",
        f"shape={_shape(m.text)}",
        f"digits={min(len(d), 20)}",
        f"luhn={12 <= len(d) <= 19 and luhn(d)},{min(len(d), 20)}",
        f"octets={len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)}",
        f"at={m.text.count('@')},{'.' in m.text.partition('@')[2]}",
        f"plus={m.text[0] == '+'},{9 <= len(d) <= 15}",
        f"edge={_shape(before)}/{_shape(after)}",
        f"length={min(len(m.text), 40) // 4}",
    ]
    return [_slot(n) for n in names]


def keys(m: Mention) -> list[str]:
    """What links distant mentions: the same value, or a similar form of it."""
    d, out = digits_of(m.text), []
    lowered = m.text.lower()
    if "@" in lowered:
        out += [f"m:{lowered}", f"l:{lowered.split('@')[0]}"]
    elif any(c.isalpha() for c in lowered):
        out.append(f"l:{lowered}")
    elif len(d) >= 7:
        out.append(f"d:{d}")
        if len(d) >= 10:
            out.append(f"t:{d[-10:]}")
    return out


def skip_edges(nodes: list[Mention]) -> list[tuple[int, int]]:
    """Each mention and the next one with the same key: linear in their number, and a
    chain through all repetitions carries a label as far as all pairs would."""
    last: dict[str, int] = {}
    edges: set[tuple[int, int]] = set()
    for i, m in enumerate(nodes):
        for key in keys(m):
            if key in last:
                edges.add((last[key], i))
            last[key] = i
    return sorted(edges)


@dataclass
class Field:
    """Trained potentials: node weights, chain and skip log potentials."""

    nodes: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray


def beliefs(unary: np.ndarray, pairs: list[tuple[int, int, np.ndarray]], rounds: int = 30) -> np.ndarray:
    """Marginals by damped loopy message passing; rows are nodes."""
    if not pairs:
        p = np.exp(unary - unary.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)
    u = np.array([a for a, _, _ in pairs] + [b for _, b, _ in pairs])
    v = np.array([b for _, b, _ in pairs] + [a for a, _, _ in pairs])
    pot = np.exp(np.stack([w for _, _, w in pairs] + [w.T for _, _, w in pairs]))
    half = len(pairs)
    back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
    messages = np.zeros((2 * half, unary.shape[1]))
    for _ in range(rounds):
        total = unary.copy()
        np.add.at(total, v, messages)
        send = total[u] - messages[back]
        send = np.exp(send - send.max(1, keepdims=True))
        new = np.log(np.einsum("el,elk->ek", send, pot) + 1e-300)
        new -= new.max(1, keepdims=True)
        change = np.abs(new - messages).max()
        messages = 0.5 * messages + 0.5 * new
        if change < 1e-4:
            break
    total = unary.copy()
    np.add.at(total, v, messages)
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


CHAIN_GAP = 40  # characters between mentions that count as neighbours


def added_spans(text: str, spans: list[Span], field: Field, least: float) -> list[Span]:
    """Spans of mentions that the field labels with at least this probability."""
    nodes = mentions(text, spans)
    if not any(not m.fixed for m in nodes):
        return []
    unary = np.array([field.nodes[features(m, text)].sum(0) for m in nodes])
    for i, m in enumerate(nodes):
        if m.fixed:  # a pattern match is evidence
            unary[i] = -30.0
            unary[i, m.label] = 30.0
    skips = skip_edges(nodes)
    near = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1].start - nodes[i].end <= CHAIN_GAP]
    linked = set(skips)
    pairs = [(a, b, field.skip) for a, b in skips] + [(a, b, field.chain) for a, b in near if (a, b) not in linked]
    p = beliefs(unary, pairs)
    out = []
    for m, row in zip(nodes, p):
        best = int(row.argmax())
        if not m.fixed and best and row[best] >= least:
            out.append((m.start, m.end, LABELS[best]))
    return out


# Training


# Contacts that any table is trained with besides its own, so that one without any has skip weights too.
CONTACTS = ("+1 (212) 555-0100", "+44 20 7946 0958", "+49-30-901820", "jane.doe@example.org", "info.desk@example.com")


def weaker(m: Mention) -> list[str]:
    """Other ways to write a phone number or mailbox that no pattern finds, but that share a key with it."""
    if LABELS[m.label] == "phone":
        d = digits_of(m.text)
        return [d, f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}", f"({d[-10:-7]}) {d[-7:-4]} {d[-4:]}"] if len(d) >= 10 else []
    if LABELS[m.label] == "email":
        name = m.text.split("@")[0]
        return [name] if len(name) >= 5 else []
    return []


def _examples(text: str) -> list[tuple[int, list[int], list[int]]]:
    """(label, features, labels of skip neighbours by number) of the mentions of a text.

    A mention that shares a key with a base span is left out: patterns cannot say that it
    is none. What it would be is shown by weaker copies of base spans, which are their kind
    beside the span and none alone.
    """
    nodes = mentions(text, base_spans(text))
    beside = np.zeros((len(nodes), len(LABELS)), dtype=int)
    for a, b in skip_edges(nodes):
        beside[a, nodes[b].label] += 1
        beside[b, nodes[a].label] += 1
    out = []
    for m, around in zip(nodes, beside, strict=True):
        if m.fixed or not around[1:].any():
            out.append((m.label, features(m, text), around.tolist()))
        for copy in weaker(m) if m.fixed else ():
            line = text[max(0, m.start - 2) : m.start] + copy + text[m.end : m.end + 2]
            start = min(m.start, 2)
            own = features(Mention(start, start + len(copy), copy, 0, False), line)
            with_span = [0] * len(LABELS)
            with_span[m.label] = 1
            out += [(m.label, own, with_span), (0, own, [0] * len(LABELS))]
    return out


def _training_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            found = _examples(text) if text else []
            if not found:
                continue
            nodes = mentions(text, base_spans(text))
            near = [
                [nodes[i].label, nodes[i + 1].label] for i in range(len(nodes) - 1)
                if nodes[i + 1].start - nodes[i].end <= CHAIN_GAP
            ]
            labels, feats, beside = zip(*found, strict=True)
            rows.append({"labels": list(labels), "features": list(feats), "beside": list(beside), "near": near})
        yield pd.DataFrame(rows, columns=["labels", "features", "beside", "near"])


TRAINING = "labels array<int>, features array<array<int>>, beside array<array<int>>, near array<array<int>>"


def _pair_potential(pairs: list) -> np.ndarray:
    """Smoothed log ratio of joint to independent label frequencies."""
    n = len(LABELS)
    counts = np.full((n, n), 0.5)
    for a, b in pairs:
        counts[a, b] += 0.5
        counts[b, a] += 0.5
    joint = counts / counts.sum()
    margin = joint.sum(0)
    return np.clip(np.log(joint) - np.log(np.outer(margin, margin)), -4, 4)


def fit(labels: list, feats: list, beside: list, epochs: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Node and skip weights by pseudo-likelihood: each label given its features and the labels
    of its skip neighbours, by adaptive gradient steps."""
    weights, skip = np.zeros((N_FEATURES, len(LABELS))), np.zeros((len(LABELS), len(LABELS)))
    y = np.eye(len(LABELS))[np.array(labels)]
    f, around = np.array([list(x) for x in feats]), np.array([list(x) for x in beside], dtype=float)
    step, seen_weights, seen_skip = 0.5, np.zeros_like(weights), np.zeros_like(skip)
    for _ in range(epochs):
        z = weights[f].sum(1) + around @ skip
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        gradient = np.zeros_like(weights)
        for k in range(f.shape[1]):
            np.add.at(gradient, f[:, k], p - y)
        gradient = gradient / len(y) + 1e-5 * weights
        seen_weights += gradient**2
        weights -= step * gradient / (np.sqrt(seen_weights) + 1e-6)
        pull = around.T @ (p - y) / len(y)
        pull = pull + pull.T + 1e-5 * skip
        seen_skip += pull**2
        skip -= step * pull / (np.sqrt(seen_skip) + 1e-6)
    return weights, skip


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 4000, epochs: int = 600) -> Field:
    """Potentials from at most about ``sample_rows`` documents, labelled by the patterns, and ``CONTACTS``."""
    sample = bounded_sample(documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", sample_rows)
    rows = sample.select("text").mapInPandas(_training_rows, TRAINING).toPandas()
    found = [x for row in rows.itertuples() for x in zip(row.labels, row.features, row.beside, strict=True)]
    found += [x for contact in CONTACTS for x in _examples(f"to {contact} or")]
    weights, skip = fit(*zip(*found, strict=True), epochs)
    return Field(weights, _pair_potential([tuple(p) for row in rows["near"] for p in row]), skip)


RESULT = "base array<struct<start:int,end:int,kind:string>>, added array<struct<start:int,end:int,kind:string>>"


def find(text: Column, field: Field, least: float = 0.95) -> Column:
    """The base and the added spans of a text column, as a struct."""

    @F.pandas_udf(RESULT)
    def spans_of(texts: pd.Series) -> pd.DataFrame:
        base, added = [], []
        for t in texts:
            b = base_spans(t)
            base.append([{"start": s, "end": e, "kind": k} for s, e, k in b])
            more = added_spans(t, b, field, least) if t else []
            added.append([{"start": s, "end": e, "kind": k} for s, e, k in more])
        return pd.DataFrame({"base": base, "added": added})

    return spans_of(text)


def redact(text: Column, field: Field, least: float = 0.95) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            if t:
                b = base_spans(t)
                pieces, at = [], 0
                for s, e, kind in sort_spans(b + added_spans(t, b, field, least)):
                    if s >= at:
                        pieces += [t[at:s], f"[{kind}]"]
                    at = max(at, e)
                t = "".join(pieces) + t[at:]
            out.append(t)
        return pd.Series(out, dtype=object)

    return cleaned(text)


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    order = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("s"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("e"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["s"].cast("string"), s["e"].cast("string"))), ",")


def report(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """Counts of base spans, their digest and all spans, for every document."""
    field = field or train(documents)
    found = documents.select("doc_id", find(F.col("text"), field).alias("f"))
    base = F.col("f.base")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(of_kind(k) for k in KINDS),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat(base, F.col("f.added"))).alias("spans"),
        F.size("f.added").cast("bigint").alias("n_added"),
    )
