"""Quality rules: base limits and a learned decision list.

Sequential covering learns rules that find low-quality texts: a rule grows by the
threshold condition with the largest gain until it covers no good text, is pruned on
held-back rows from its end, and is kept if it is precise there; the rows it covers
leave, and the next rule follows. The list becomes one Spark conditional expression:
the first rule that holds rejects, a text that no rule meets is kept.

All labelled rows count. They are reduced to cells first: each statistic is cut at a
few quantiles, and Spark counts labels per combination of intervals. The driver sees
the cells only, at most 5^7 combinations with two labels and two folds.

Defined results: null texts and texts without a word have no words and fail the base
limits; every statistic is of the whole text; without low-quality labels nothing but
the base limits rejects.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.common import SPACE, bind, stored, words

RUN = 8  # words of a window that counts as repeated
SYMBOLS = "#*$%&|<>"


def _repeated_words(w: Column) -> Column:
    """Words inside eight-word windows that occur at least twice."""

    def of_windows(h: Column) -> Column:
        # Windows in order of hash and place; those with an equal neighbour are repeated.
        def of_sorted(s: Column) -> Column:
            same = lambda i, j: F.get(s, i)["h"] == F.get(s, j)["h"]
            twice = F.filter(s, lambda x, i: F.coalesce(same(i, i + 1), F.lit(False)) | F.coalesce(F.when(i > 0, same(i, i - 1)), F.lit(False)))
            places = F.array_sort(F.transform(twice, lambda x: x["p"]))
            # Each window adds the words up to the next one, eight at most.
            start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-RUN).alias("end"))

            def add(acc: Column, p: Column) -> Column:
                return F.struct((acc["n"] + F.least(F.lit(RUN), p + RUN - acc["end"])).cast("bigint").alias("n"), (p + RUN).alias("end"))

            return F.aggregate(places, start, add, lambda acc: acc["n"])

        marked = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), bind(F.array_sort(marked), of_sorted)).otherwise(F.lit(0).cast("bigint"))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (RUN - 1)), lambda i: F.xxhash64(F.slice(w, i, RUN)))
    return F.when(F.size(w) > RUN, bind(hashes, of_windows)).otherwise(F.lit(0).cast("bigint"))


def statistics(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every text."""
    text = F.coalesce("text", F.lit(""))
    squeezed = F.regexp_replace(text, SPACE, "")
    chars = F.char_length(squeezed)
    count = lambda pattern: F.regexp_count(squeezed, F.lit(pattern)).cast("bigint")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = bind(words(F.col("text")), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), _repeated_words(w).alias("r")))
    of_lines = bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))
    return documents.select(
        "doc_id",
        of_words.alias("w"),
        chars.cast("bigint").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        of_lines.alias("n_dup_lines"),
        count(r"\p{Lu}").alias("n_upper"),
        count(r"[!?]").alias("n_marks"),
        F.size(F.split(text, "\n")).cast("bigint").alias("n_lines"),
    ).select(
        "doc_id", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.r").alias("n_repeat_words"), "n_upper", "n_marks", "n_lines"
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def measures() -> dict[str, Column]:
    """What rules may ask for, from the columns of ``statistics``."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": per("word_chars", "n_words"),
        "symbols": per("n_symbols", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "upper": per("n_upper", "word_chars"),
        "marks": per("n_marks", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool  # else: at most
    cut: float

    def holds(self) -> Column:
        value = measures()[self.measure]
        return value > self.cut if self.above else value <= self.cut


Rule = tuple[Condition, ...]
CUTS = (0.01, 0.5, 0.99, 0.999)  # of the good rows: the ends where low quality shows, and the middle


def learn(stats: DataFrame, labels: DataFrame, precision: float = 0.9, most_rules: int = 12, support: int = 3) -> list[Rule]:
    """Rules for low quality from all labelled rows."""
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = stats.join(known, "doc_id").select(
        *(m.alias(k) for k, m in measures().items()), "quality", (F.pmod(F.xxhash64(F.lit(41), "doc_id"), F.lit(3)) == 0).alias("held")
    )
    names = list(measures())
    good = F.col("quality") == 1
    found = rows.where(good).agg(*(F.percentile_approx(k, list(CUTS), 2000).alias(k) for k in names)).first()
    if found[names[0]] is None:
        return []
    cuts = {k: sorted(set(found[k])) for k in names}
    binned = [sum((F.col(k) > c).cast("int") for c in cuts[k]).alias(k) for k in names]
    cells = [
        (tuple(r[k] for k in names), r["quality"] == 1, r["held"], r["n"])
        for r in rows.select(*binned, "quality", "held").groupBy(*names, "quality", "held").agg(F.count("*").alias("n")).collect()
    ]
    options = [(i, above, b) for i, k in enumerate(names) for b in range(len(cuts[k])) for above in (True, False)]

    def covers(rule, cell) -> bool:
        return all((cell[i] > b) == above for i, above, b in rule)

    def counts(rule, chosen) -> tuple[int, int]:
        bad = sum(n for c, is_good, _, n in chosen if not is_good and covers(rule, c))
        return bad, sum(n for c, is_good, _, n in chosen if is_good and covers(rule, c))

    rules: list[Rule] = []
    left = cells
    while len(rules) < most_rules:
        grow = [c for c in left if not c[2]]
        prune = [c for c in left if c[2]] or grow
        rule: list = []
        covered = grow
        bad, fine = counts(rule, covered)
        while bad and fine and len(rule) < 4:
            before = math.log2(bad / (bad + fine))
            gains = []
            for o in options:
                p, n = counts([o], covered)
                if p >= support:
                    gains.append((p * (math.log2(p / (p + n)) - before), o))
            if not gains or max(gains)[0] <= 1e-9:
                break
            rule.append(max(gains)[1])
            covered = [c for c in covered if covers(rule, c[0])]
            bad, fine = counts(rule, covered)
        if not rule or not bad:
            break
        # Conditions go from the end while the share of low quality among held-back rows does not fall.
        share = lambda r: (lambda p, n: (p - n) / max(1, p + n))(*counts(r, prune))
        while len(rule) > 1 and share(rule[:-1]) >= share(rule):
            rule = rule[:-1]
        p, n = counts(rule, prune)
        bad, fine = counts(rule, grow)
        if bad < support or p + bad < precision * (p + n + bad + fine):
            break
        rules.append(tuple(Condition(names[i], above, float(cuts[names[i]][b])) for i, above, b in rule))
        left = [c for c in left if not covers(rule, c[0])]
    return rules


def kept(rules: list[Rule]) -> Column:
    """The decision list: the first rule that holds rejects, otherwise the text is kept."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.holds()
        verdict = F.when(holds, F.lit(False)).otherwise(verdict)
    return verdict


def report(documents: DataFrame, labels: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Statistics, base limits and verdict of every document."""
    stats = statistics(documents)
    if rules is None:
        # Labels meet the few numbers of a text, not the text.
        stats = stored(documents.sparkSession, stats, "quality-statistics")
        rules = learn(stats, labels)
    failed = base_failed()
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & kept(rules)).alias("kept")
    )
