"""Quality rules: a decision list learned by sequential covering.

Text measures are column expressions.  The learner works on labelled
statistics: each measure of the labelled rows is cut at quantiles, and equal
combinations of bins are counted with their labels.  Every growing step asks
Spark for one histogram (measure x bin, positives and negatives still
covered), which has at most ``measures * (cuts + 1)`` rows, and adds the
threshold with the largest information gain.  A grown conjunction is pruned on
held-back rows; rules are added while they are precise there.  The list is
emitted as one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import uniform, with_outputs
from stockpulse.session import materialize

# The separators and symbols of the contract.
SEPARATORS = " \t\n\x0b\x0c\r"
SEPARATOR_RUN = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = {
    "mean_word_chars": lambda c: c["word_chars"] / F.greatest(c["n_words"], F.lit(1)),
    "symbols_per_word": lambda c: c["n_symbols"] / F.greatest(c["n_words"], F.lit(1)),
    "repeat_share": lambda c: c["n_repeat_words"] / F.greatest(c["n_words"], F.lit(1)),
    "dup_lines_per_word": lambda c: c["n_dup_lines"] / F.greatest(c["n_words"], F.lit(1)),
}
MEASURES = [*COUNTS, *RATES]
CUT_SHARES = [0.005, 0.01, 0.02, 0.05, *[i / 20 for i in range(2, 19)], 0.95, 0.98, 0.99, 0.995]


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by its measures (``COUNTS`` and ``RATES``); a null text has no words, lines or symbols.

    Repeated three-word windows are found by 64-bit hashes of the windows.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(t, F.lit(SEPARATORS))
    # one column a step: what is used twice is computed once
    df = docs.select("*", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATOR_RUN)).alias("_words"),
                     F.filter(F.split(t, "\n", -1), lambda x: x.rlike(HAS_WORD)).alias("_lines"),
                     F.regexp_count(t, F.lit(SYMBOL)).alias("_symbols"))
    df = df.withColumn("_windows", F.transform(
        F.slice("_words", 1, F.greatest(F.size("_words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(repeats, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.transform(
        F.filter(F.transform("_sorted", lambda x, j: F.struct(
            x["i"].alias("i"),
            (F.coalesce(x["h"] == F.get("_sorted", j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("_sorted", j + 1)["h"], F.lit(False))).alias("again"))),
            lambda x: x["again"]), lambda x: x["i"])
    df = df.withColumn("_again", F.array_sort(again))
    # a window covers its three words; the next repeated window may overlap it
    covered = F.aggregate(F.transform("_again", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("_again", j + 1) - i, F.lit(3)))), F.lit(0), lambda s, x: s + x)
    counts = {
        "n_words": F.size("_words"), "word_chars": F.char_length(F.array_join("_words", "")), "n_symbols": F.col("_symbols"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")), "n_repeat_words": F.coalesce(covered, F.lit(0))}
    df = with_outputs(df, {n: c.cast("long") for n, c in counts.items()})
    df = with_outputs(df, {n: f(df) for n, f in RATES.items()})
    return df.drop(text, "_words", "_lines", "_symbols", "_windows", "_sorted", "_again")


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    value: float

    def column(self) -> Column:
        return F.col(self.measure) > self.value if self.above else F.col(self.measure) <= self.value

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.value:g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered conjunctions that reject; what none of them meets is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def verdict(self) -> Column:
        """True: keep.  The first rule that holds decides."""
        out = None
        for rule in self.rules:
            held = F.lit(True)
            for c in rule:
                held = held & c.column()
            out = F.when(held, F.lit(False)) if out is None else out.when(held, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def rule_number(self) -> Column:
        """Position of the rule that decides, from 1; 0 where none holds."""
        out = F.lit(0)
        for i, rule in reversed(list(enumerate(self.rules, 1))):
            held = F.lit(True)
            for c in rule:
                held = held & c.column()
            out = F.when(held, F.lit(i)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"{i}. {' and '.join(map(str, r))} -> reject" for i, r in enumerate(self.rules, 1))


def learn_decision_list(labelled: DataFrame, label: str = "quality", key: str = "doc_id", max_rules: int = 12, max_conditions: int = 4,
                        min_precision: float = 0.8, min_covered: int = 10, held_back: float = 0.33, seed: int = 5) -> DecisionList:
    """Learn rules for label 0 from rows that hold ``MEASURES`` and a label; other labels than 0 and 1 are left out.

    A rule needs ``min_covered`` growing rows, and ``min_precision`` on the
    held-back rows (a share of ``held_back``, drawn by a hash of the key).
    Without rows of both labels the list is empty, which keeps everything.
    """
    rows = labelled.where(F.col(label).isin(0, 1))
    cuts = rows.agg(*[F.percentile_approx(m, CUT_SHARES, 2000).alias(m) for m in MEASURES]).first()
    if cuts[MEASURES[0]] is None:
        return DecisionList(())
    edges = {m: sorted(set(map(float, cuts[m]))) for m in MEASURES}
    # a threshold lies midway between the values on its two sides
    above = rows.agg(*[F.min(F.when(F.col(m) > e, F.col(m))).alias(f"{m}_{i}") for m in MEASURES for i, e in enumerate(edges[m])]).first()
    edges = {m: [e if (x := above[f"{m}_{i}"]) is None else (e + float(x)) / 2 for i, e in enumerate(edges[m])] for m in MEASURES}

    def bin_of(m: str) -> Column:  # the number of cuts below the value
        return F.aggregate(F.array(*[F.lit(e) for e in edges[m]]), F.lit(0), lambda s, e: s + (F.col(m) > e).cast("int")).alias(m)

    # labelled statistics: equal combinations of bins are one row
    cells = materialize(rows.select(*[bin_of(m) for m in MEASURES], (uniform(F.lit(seed), F.col(key)) < held_back).alias("_held"),
                                    (F.col(label) == 0).cast("long").alias("p"), (F.col(label) == 1).cast("long").alias("n"))
                        .groupBy(*MEASURES, "_held").agg(F.sum("p").alias("p"), F.sum("n").alias("n")), "quality-cells")

    def holds(rule) -> Column:
        out = F.lit(True)
        for m, above, b in rule:
            out = out & (F.col(m) > b if above else F.col(m) <= b)
        return out

    def histogram(where: Column) -> dict[str, list[tuple[int, int]]]:
        bins = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("b")) for m in MEASURES]))
        found = cells.where(where).select(bins.alias("x"), "p", "n").groupBy("x.m", "x.b").agg(F.sum("p"), F.sum("n")).collect()
        out = {m: [(0, 0)] * (len(edges[m]) + 1) for m in MEASURES}
        for m, b, p, n in found:
            out[m][b] = (p, n)
        return out

    def best(counts, rule):
        p0, n0 = (sum(x[i] for x in counts[MEASURES[0]]) for i in (0, 1))
        top = (1e-9, None)
        for m in MEASURES:
            p = n = 0
            for b in range(len(edges[m])):
                p, n = p + counts[m][b][0], n + counts[m][b][1]
                for above, (q, r) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    if q >= min_covered and q + r < p0 + n0:
                        gain = q * (math.log2(q / (q + r)) - math.log2(p0 / (p0 + n0)))
                        if gain > top[0]:
                            top = (gain, (m, above, b))
        return top[1], (p0, n0)

    rules, left = [], F.lit(True)
    for _ in range(max_rules):
        rule = []
        while len(rule) < max_conditions:
            condition, (p, n) = best(histogram(left & ~F.col("_held") & holds(rule)), rule)
            if p < min_covered or n == 0 or condition is None:
                break
            rule.append(condition)
        if not rule:
            break
        # prune from the end: the shortest beginning that is most precise on the held-back rows
        sums = [F.coalesce(F.sum(F.when(holds(rule[:i]), F.col(c))), F.lit(0)) for i in range(1, len(rule) + 1) for c in ("p", "n")]
        seen = cells.where(left & F.col("_held")).agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        value = [(seen[2 * i] - seen[2 * i + 1]) / max(1, seen[2 * i] + seen[2 * i + 1]) for i in range(len(rule))]
        size = max(range(len(rule)), key=lambda i: (value[i], -i)) + 1
        p, n = seen[2 * size - 2], seen[2 * size - 1]
        if p == 0 or p < min_precision * (p + n):
            break
        rule = rule[:size]
        rules.append(tuple(Condition(m, above, edges[m][b]) for m, above, b in rule))
        left = left & ~holds(rule)
    return DecisionList(tuple(rules))


def apply_quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
                        min_words: int = 50, max_repeat_percent: int = 50, **learning) -> tuple[DataFrame, DecisionList]:
    """Measure every row, learn a list from the labelled ones, and add ``base_failed``, ``rule`` and ``kept``.

    The base fails below ``min_words`` words or with more than
    ``max_repeat_percent`` percent repeated words; such a row is not kept.
    The list is learned from the labelled rows that pass the base (all of
    them: the learner sees counts alone).  A null text has 0 words, so it
    fails the base.  Keys with conflicting labels are not learned from, null
    keys have no label, repeated rows are judged alike.  The text column is
    not returned; input columns named like an output are replaced.
    """
    rows = text_measures(docs, text)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = materialize(with_outputs(rows, {"base_failed": failed}), "quality-measures")
    agreed = (labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("_key"))
              .agg(F.min(label).alias("_label"), F.max(label).alias("_other")).where("_label = _other"))
    labelled = rows.where(~F.col("base_failed")).select(F.col(key).alias("_key"), *MEASURES).join(agreed, "_key")
    found = learn_decision_list(labelled, label="_label", key="_key", **learning)
    return with_outputs(rows, {"rule": found.rule_number(), "kept": ~F.col("base_failed") & found.verdict()}), found
