"""Conversation repair against a search through all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

from pyspark.sql import functions as F

from tallystream.llm import turns

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def damage(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        out.setdefault(conv_id, [])
        h = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        out[conv_id] += [] if h == 0 else [(turn, role, text)] * (2 if h == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows):
    """Least (cost, audit) over every edit of every row and up to two insertions in every gap, with its text."""
    best = None
    marks = faults(rows)
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    gaps = product(inserts, repeat=len(rows) + 1)
    edits = list(product(["K", "D", "user", "assistant"], repeat=len(rows)))
    for gap in gaps:
        for edit in edits:
            cost, audit, lines = 0, "", []
            for i in range(len(rows) + 1):
                for role in gap[i]:
                    cost, audit = cost + 3, audit + "I"
                    lines.append((role, ""))
                if i == len(rows):
                    break
                if edit[i] == "D":
                    cost, audit = cost + 4, audit + "D"
                    continue
                if marks[i] in ("blank", "duplicate"):
                    cost = None
                    break
                cost += (edit[i] != "K") * 3 + (marks[i] == "truncated") * 3
                audit += "K" if edit[i] == "K" else "R"
                lines.append((rows[i][1] if edit[i] == "K" else edit[i], rows[i][2]))
            if cost is None or (best and (cost, audit) >= best[:2]):
                continue
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in lines)):
                best = cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)
    return best


def expected(rows):
    out = {}
    for conv_id, left in damage(rows).items():
        marks = faults(left)
        given = [t for t, _, _ in left if t is not None]
        cost, audit, text = search(left)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(left, left[1:])]
        out[conv_id] = (
            max(given) - min(given) + 1 - len(set(given)) if given else 0, marks.count("blank"), marks.count("duplicate"),
            marks.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, CONVERSATIONS).withColumns({"id": F.lit(1), "seg": F.lit("x"), "audit": F.lit(2), "h": F.lit(3)})
    df = turns.repair(frame, **options)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = df.collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "assistant", "system", "tool", None, "", "Ünder"])
            text = rng.choice(["Yes.", "No!", "Why?", "cut off", " \t", None, "", f"Turn {t}.", "é…\n"])
            rows.append((c, rng.choice([t, t, t + 1, None]), role, text))
    return rows


def test_matches_search_over_all_edits(spark):
    rows = conversations(1, 40, 2) + [(c + 100, *r) for c, *r in conversations(2, 12, 3)]
    want = expected(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, segment=1) == want
    assert found(spark, rows, segment=2) == want


def test_segments_change_nothing(spark):
    rows = conversations(3, 8, 60)
    whole = found(spark, rows)
    assert found(spark, rows, segment=7) == whole
    assert any(len(v[6]) > 30 for v in whole.values())


def test_one_long_conversation(spark):
    """Thousands of rows in one conversation, over many segments, against a plain search by text."""
    rng = random.Random(4)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"Turn {t}.", "cut"])) for t in range(2500)]
    left = damage(rows)[5]
    marks = faults(left)
    best = [(0, ""), (6, "II"), (3, "I"), (0, "")]
    for (_, role, _), fault in zip(reversed(left), reversed(marks)):
        plain = []
        for state in range(4):
            ways = [(best[state][0] + 4, "D" + best[state][1])]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                made = turns.MADE[state]
                ways.append((best[made][0] + 3 + extra, "R" + best[made][1]))
                if state in turns.KEEPS[role[0]]:
                    kept = best[turns.KEEPS[role[0]][state]]
                    ways.append((kept[0] + extra, "K" + kept[1]))
            plain.append(min(ways))
        once = [min(p, (plain[turns.MADE[s]][0] + 3, "I" + plain[turns.MADE[s]][1])) for s, p in enumerate(plain)]
        best = [min(p, (once[turns.MADE[s]][0] + 3, "I" + once[turns.MADE[s]][1])) for s, p in enumerate(once)]
    got = found(spark, rows, segment=128)[5]
    assert got[5:7] == best[0]


def test_awkward_tables(spark):
    assert found(spark, []) == {}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    big = (1 << 60) + 1
    rows = [
        (gone, 0, "user", "Hello."), (None, None, None, None), (None, None, None, None), (None, 3, "user", "Hi."),
        (big, big + 2, "user", "Hi."), (big, None, "assistant", "Yes."), (big, big, "system", "Go."), (big + 1, 1, "user", "a" * 200000),
    ]
    got = found(spark, rows)
    assert got == expected(rows) and got[gone] == nothing
    ends = [(1, -(1 << 63), "user", "Hi."), (1, (1 << 63) - 1, "assistant", "Yes.")]
    assert found(spark, ends)[1][0] <= turns.LONGEST


def test_weights_order_as_cost_then_text():
    w = turns.Weights(6)
    texts = ["", "D", "DI", "DK", "I", "KD", "KDI", "R", "RRRRR"]
    weights = {}
    for cost in (0, 3, 7):
        for t in texts:
            weight = cost << w.low
            for letter in reversed(t):
                weight = w.after(turns.LETTERS.index(letter) + 1, 0, weight)
            assert w.audit(weight) == t and w.cost(weight) == cost
            weights[cost, t] = weight
    assert sorted(weights, key=weights.get) == sorted(weights)
