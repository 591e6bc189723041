"""Repair of conversations by the cheapest edits, the least audit text among equals.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``. Every row is
kept, given another role or deleted, and turns may be inserted; the letters D, I, K, R of
these edits in order are the audit. Cost and audit together are one integer: the high
digits hold the cost, the low ones a fixed number of octal digits for the letters, first
letter first, filled with zeros at the end. So the ordinary minimum of integers is the
cheapest way, and among equals the least audit (a shorter one before its continuations).
The integer of the best rest of a conversation is worked out from its last row to its
first over a graph of rows and four states of the pattern: an edit adds its cost to the
high digits and puts its letter before the low ones.

Rows are put in one order by ranges, which spreads a long conversation over many tasks,
and cut into segments of ``SEGMENT`` rows. Every segment is solved by itself, for each
state before and after it; a conversation's segments are then put together from the last
to the first. Two ways of the same cost through a segment never continue each other, since
more letters for the same rows are insertions, which cost; so the least way through a
segment stays the least whatever follows. The hash of the repaired text needs one pass
over a conversation in order; it holds one row at a time.

Defined results: a null role or text is one space, as is a null id or turn in the
checksum. Rows of one turn go by role and text, rows that repeat all of it side by side.
Rows without an id are one conversation. ``gaps`` beyond the range of a long is its
greatest value. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import stored
from tallystream.operators.ordering import with_ordinal

SEGMENT = 1024
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"

# States of the pattern: nothing yet, after a system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
MADE = (USER, USER, ASSISTANT, USER)  # what an inserted or renamed turn makes of each state

NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
LETTERS = "DIKR"  # their digits are 1 to 4, 0 is the end
DELETE, INSERT, KEEP, RENAME = (LETTERS.index(c) + 1 for c in "DIKR")
COST = {DELETE: 4, INSERT: 3, KEEP: 0, RENAME: 3}
UNMENDED = 3
BITS = 3
LEGAL = {"su", "ua", "au"}

LONGEST = (1 << 63) - 1
NO_WAY = -1


class Weights:
    """Integers of a cost and up to ``width`` letters."""

    def __init__(self, width: int):
        self.low = BITS * width
        self.top = self.low - BITS
        self.mask = (1 << self.low) - 1

    def after(self, letter: int, cost: int, rest: int) -> int:
        """The weight of a letter followed by a rest that has room for it."""
        return ((rest >> self.low) + cost << self.low) | letter << self.top | (rest & self.mask) >> BITS

    def cost(self, weight: int) -> int:
        return weight >> self.low

    def audit(self, weight: int) -> str:
        digits = oct((weight & self.mask) | 1 << self.low)[3:].rstrip("0")
        return digits.translate({ord("1") + k: c for k, c in enumerate(LETTERS)})


def _width(rows: int) -> int:
    """Room for an edit of each row and two insertions before it, and two at the end."""
    return 3 * rows + 3


def _with_insertions(w: Weights, plain: list) -> list:
    """The best from each state when up to two turns may be inserted first: more come back
    to a state already met."""
    out = list(plain)
    for _ in range(2):
        for state, best in enumerate(list(out)):
            follow = out[MADE[state]]
            if follow is not None:
                way = w.after(INSERT, COST[INSERT], follow)
                if best is None or way < best:
                    out[state] = way
    return out


def through(w: Weights, rows: list[tuple[str, int]], end: list) -> list:
    """The best weight from each state through ``rows`` of (initial, fault), given those after."""
    best = end
    for initial, fault in reversed(rows):
        keeps = KEEPS.get(initial, {})
        extra = UNMENDED if fault == TRUNCATED else 0
        plain = []
        for state in STATES:
            ways = []
            if best[state] is not None:
                ways.append(w.after(DELETE, COST[DELETE], best[state]))
            if fault not in (BLANK, DUPLICATE):
                if state in keeps and best[keeps[state]] is not None:
                    ways.append(w.after(KEEP, COST[KEEP] + extra, best[keeps[state]]))
                if best[MADE[state]] is not None:
                    ways.append(w.after(RENAME, COST[RENAME] + extra, best[MADE[state]]))
            plain.append(min(ways, default=None))
        best = _with_insertions(w, plain)
    return best


# Damage and faults, row by row

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, drawn by the checksum of conversation and turn."""
    space = F.lit(" ")
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), space)
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("unnamed"),
        F.col("turn").cast("bigint").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"),
        (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20).alias("h"),
    ).where("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = rows.withColumn("copy", copies)
    return rows.select("conv_id", "unnamed", "turn", role.alias("role"), text.alias("text"))


def _faulty(ordered: DataFrame) -> DataFrame:
    """``conv_id, unnamed, id, dated, turn, initial, fault``: the first fault of each row; rows without a
    turn have the turn 0 and are not dated, since pandas would make a column with nulls one of floats."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    digests = F.xxhash64("role", "text").alias("d1"), F.xxhash64(F.lit(1), "role", "text").alias("d2")
    rows = ordered.select(
        "conv_id", "unnamed", "id", F.col("turn").isNotNull().alias("dated"), F.coalesce("turn", F.lit(0)).alias("turn"),
        F.left("role", F.lit(1)).alias("initial"), *digests,
        F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(list(ENDS)), TRUNCATED).otherwise(NO_FAULT).alias("own"),
    )
    # Only what stands there twice has to be looked up.
    same = ["conv_id", "unnamed", "d1", "d2"]
    twice = rows.groupBy(*same).agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    met = rows.join(twice, same, "left")
    again = (F.col("own") != BLANK) & (F.col("id") > F.col("first"))
    return met.select(
        "conv_id", "unnamed", "id", "dated", "turn", "initial",
        F.when(again, DUPLICATE).otherwise(F.col("own")).alias("fault"),
    )


# Segments

KEY = ("conv_id", "unnamed")
SEGMENTS = """conv_id bigint, unnamed boolean, seg bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,
    head string, tail string, low bigint, high bigint, turns bigint, costs array<bigint>, audits array<string>"""
REPAIRS = """conv_id bigint, unnamed boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,
    cost bigint, audit string"""
HASHED = "conv_id bigint, unnamed boolean, repaired_sha256 string"


def _tuples(batches: Iterable[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].astype(object).where(batch[c].notna(), None) for c in batch.columns))


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each segment's counts and the best way through it: from every state to every state."""
    out = []
    for (conv_id, unnamed, seg), group in groupby(_tuples(batches), key=lambda r: r[:3]):
        rows = list(group)  # no more than a segment holds
        edits = [(initial, fault) for *_, initial, fault in rows]
        turns = [turn for _, _, _, _, dated, turn, _, _ in rows if dated]
        w = Weights(_width(len(rows)))
        costs, audits = [], []
        for end in STATES:
            for best in through(w, edits, [0 if s == end else None for s in STATES]):
                costs.append(NO_WAY if best is None else w.cost(best))
                audits.append("" if best is None else w.audit(best))
        faults = [fault for _, fault in edits]
        out.append((
            conv_id, unnamed, seg, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            sum(a[0] + b[0] not in LEGAL for a, b in zip(edits, edits[1:])), edits[0][0], edits[-1][0],
            turns[0] if turns else 0, turns[-1] if turns else 0,
            sum(a != b for a, b in zip(turns, turns[1:])) + bool(turns), costs, audits,
        ))
        if len(out) == 256:
            yield _frame(out, SEGMENTS)
            out = []
    yield _frame(out, SEGMENTS)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(",")], dtype=object)


def _number(audit: str) -> int:
    """The letters as octal digits."""
    return int("0" + audit.translate({ord(c): str(k + 1) for k, c in enumerate(LETTERS)}), 8)


def _assembled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each conversation from its segments, last one first."""
    out = []
    for (conv_id, unnamed), group in groupby(_tuples(batches), key=lambda r: r[:2]):
        best = [(0, 0, 0), (6, _number("II"), 2), (3, _number("I"), 1), (0, 0, 0)]  # cost, letters, their number
        total = [0, 0, 0, 0]
        turns, low, high, after, after_low = 0, None, None, None, None
        for _, _, _, *counts, head, tail, first, last, distinct, costs, audits in group:
            total = [a + b for a, b in zip(total, counts)]
            if after is not None and tail + after not in LEGAL:
                total[3] += 1
            after = head
            if distinct:
                turns += distinct - (last == after_low)
                low, after_low = first, first
                high = last if high is None else high
            best = [
                _least((costs[4 * end + state], audits[4 * end + state], best[end]) for end in STATES)
                for state in STATES
            ]
        cost, letters, length = best[START]
        audit = Weights(length).audit(letters) if length else ""
        gaps = 0 if low is None else min(high - low + 1 - turns, LONGEST)
        out.append((conv_id, unnamed, gaps, *total, cost, audit))
        if len(out) == 256:
            yield _frame(out, REPAIRS)
            out = []
    yield _frame(out, REPAIRS)


def _least(ways: Iterable[tuple]) -> tuple[int, int, int]:
    """The least (cost, letters) of a way through a segment and the best rest after it.

    Letters of ways that differ in length are compared with zeros at the end."""
    best = None
    for cost, audit, (rest_cost, rest, length) in ways:
        if cost == NO_WAY or (best is not None and cost + rest_cost > best[0]):
            continue
        way = (cost + rest_cost, _number(audit) << BITS * length | rest, len(audit) + length)
        if best is None or way[0] < best[0]:
            best = way
            continue
        wide = max(way[2], best[2])
        if way[1] << BITS * (wide - way[2]) < best[1] << BITS * (wide - best[2]):
            best = way
    return best


# The repaired text

class Writer:
    """Hashes the repaired conversation row by row as its audit says."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.sha, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.sha.update((f"\n{role}:{text}" if self.lines else f"{role}:{text}").encode())
        self.lines += 1

    def _made(self, text: str) -> None:
        self.state = MADE[self.state]
        self._line("user" if self.state == USER else "assistant", text)

    def inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._made("")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = KEEPS[role[0]][self.state]
            self._line(role, text)
        elif letter == "R":
            self._made(text)

    def digest(self) -> str:
        self.inserted()
        return self.sha.hexdigest()


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for (conv_id, unnamed), group in groupby(_tuples(batches), key=lambda r: r[:2]):
        writer = Writer(next(group)[5])
        for _, _, _, role, text, _ in group:
            writer.row(role, text)
        out.append((conv_id, unnamed, writer.digest()))
        if len(out) == 256:
            yield _frame(out, HASHED)
            out = []
    yield _frame(out, HASHED)


def repair(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per original conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256`` of its damaged rows."""
    spark = conversations.sparkSession
    order = "conv_id", "unnamed", F.asc_nulls_first("turn"), "role", "text"
    ordered = stored(spark, with_ordinal(damaged(conversations), *order, name="id"), "turns-order")
    rows = _faulty(ordered).select(*KEY, F.expr(f"id div {segment}").alias("seg"), "id", "dated", "turn", "initial", "fault")
    rows = rows.repartition(*KEY, "seg").sortWithinPartitions(*KEY, "seg", "id")
    segments = rows.mapInPandas(_solved, SEGMENTS)
    segments = segments.repartition(*KEY).sortWithinPartitions(*KEY, F.desc("seg"))
    repairs = stored(spark, segments.mapInPandas(_assembled, REPAIRS), "turns-repairs")

    # The audit goes before the rows it is about.
    none = F.lit(None).cast("string")
    plans = repairs.select(*KEY, F.lit(-1).cast("bigint").alias("id"), none.alias("role"), none.alias("text"), "audit")
    texts = plans.unionByName(ordered.select(*KEY, "id", "role", "text", none.alias("audit")))
    hashed = texts.repartition(*KEY).sortWithinPartitions(*KEY, "id").mapInPandas(_hashed, HASHED)

    every = conversations.select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("unnamed")
    ).distinct()
    out = every.join(repairs, list(KEY), "left").join(hashed, list(KEY), "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select(
        F.when(~F.col("unnamed"), F.col("conv_id")).alias("conv_id"),
        *(count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
