"""Quality rules: a learned, ordered decision list over the text's statistics.

Base rule: a text fails with fewer than 20 words, or when repeated 8-word
windows cover more than 30 % of its words.  The rest is judged by a decision
list learned from labelled statistics by sequential covering: a rule is grown
on two thirds of the rows by adding the threshold test with the best
information gain, pruned from its end on the other third, and kept while it is
precise there; the rows it covers are taken away and the next rule is grown.
Every rule is a readable conjunction such as ``symbols_per_word > 0.45 and
n_words > 30``, and the list becomes one ordered Spark ``CASE`` expression; what no
rule covers is kept.

Defined cases: a null or empty text has no words and fails the base rule;
without labels of both classes the list is empty; of a labelled id's several
texts the one with the smallest counts is learned; repeated rows each get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstat.llm.quality_ranker import text_stats_with_labels
from regstat.llm.text_stats import COUNTS, counted, text_stats

MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
MAX_LABELLED = 20_000       # labelled documents of the fit
CUTS = 64                   # candidate thresholds of a statistic
MIN_PRECISION = 0.9         # of a rule, on the rows kept for pruning
MAX_TESTS, MAX_RULES = 4, 16

#: Statistic -> (numerator, denominator) of the counts; a zero denominator counts as one.
STATISTICS = {"n_words": ("n_words", None), "symbols_per_word": ("n_symbols", "n_words"), "dup_lines_per_line": ("n_dup_lines", "n_lines"),
              "repeat_words_per_word": ("n_repeat_words", "n_words"), "upper_per_byte": ("n_upper", "n_bytes"), "digits_per_byte": ("n_digits", "n_bytes"),
              "marks_per_word": ("n_marks", "n_words"), "exclaims_per_word": ("n_exclaims", "n_words"), "pipes_per_word": ("n_pipes", "n_words"),
              "twins_per_word": ("n_twins", "n_words"), "chars_per_word": ("word_chars", "n_words"), "distinct_per_word": ("n_distinct", "n_words")}


class Test(NamedTuple):
    statistic: str
    above: bool          # the test is "> cut", else "<= cut"
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.statistic] > self.cut if self.above else x[self.statistic] <= self.cut

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:.6g}"


def statistics(counts: np.ndarray) -> dict[str, np.ndarray]:
    c = dict(zip(COUNTS, counts.T.astype(float), strict=True))
    return {k: c[a] / np.maximum(c[b], 1) if b else c[a] for k, (a, b) in STATISTICS.items()}


def statistic_columns() -> list[Column]:
    return [(F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)) if b else F.col(a).cast("double")).alias(k) for k, (a, b) in STATISTICS.items()]


def _covers(rule: list[Test], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for t in rule:
        out &= t.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Test]:
    rule: list[Test] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_TESTS and (~bad[inside]).any():
        p0, n0 = bad[inside].sum(), inside.sum()
        best, gain = None, 1e-9
        for name, values in x.items():
            v, y = values[inside], bad[inside]
            for cut in np.unique(np.quantile(v, np.linspace(0, 1, CUTS + 1)[1:-1])):
                for above in (True, False):
                    hit = v > cut if above else v <= cut
                    p, n = y[hit].sum(), hit.sum()
                    if p and (g := p * (np.log2(p / n) - np.log2(p0 / n0))) > gain:
                        best, gain = Test(name, above, float(cut)), g
        if best is None:
            break
        v = x[best.statistic][inside]
        cut = float((v[v <= best.cut].max(initial=best.cut) + v[v > best.cut].min(initial=v.max())) / 2)     # amid the gap of the rows seen
        best = best._replace(cut=cut)
        inside &= best.holds(x)
        rule = [t for t in rule if (t.statistic, t.above) != (best.statistic, best.above)] + [best]      # the tighter test holds the looser one
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[list[Test]]:
    """Ordered rules for the bad rows; deterministic in the order of the rows."""
    rules: list[list[Test]] = []
    left = np.ones(len(bad), bool)
    while bad[left].any() and (~bad).any() and len(rules) < MAX_RULES:
        at = np.flatnonzero(left)
        grow, prune = at[np.arange(len(at)) % 3 != 2], at[np.arange(len(at)) % 3 == 2]
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow])
        held = {k: v[prune] for k, v in x.items()}

        def worth(tests: list[Test], held=held, prune=prune) -> float:
            hit = _covers(tests, held, len(prune))
            p, n = bad[prune][hit].sum(), hit.sum()
            return (2 * p - n) / n if n else -1.0
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule or (worth(rule) + 1) / 2 < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~_covers(rule, x, len(bad))
    return rules


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[list[Test]]:
    """The list for documents that pass the base rule."""
    rows = text_stats_with_labels(docs, labels, "quality", max_labelled)
    counts, label = rows[:, :len(COUNTS)], rows[:, -1]
    c = dict(zip(COUNTS, counts.T, strict=True))
    passed = (c["n_words"] >= MIN_WORDS) & (100 * c["n_repeat_words"] <= MAX_REPEAT_PERCENT * c["n_words"])
    return learn(statistics(counts[passed]), label[passed] == 0)


def verdict(rules: list[list[Test]]) -> Column:
    """One ordered expression: the number of the first rule that covers the row, null if none does."""
    expr = None
    for i, rule in enumerate(rules):
        covered = F.lit(True)
        for t in rule:
            covered = covered & t.column()
        expr = F.when(covered, F.lit(i)) if expr is None else expr.when(covered, F.lit(i))
    return F.lit(None).cast("int") if expr is None else expr


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, rules: list[list[Test]]) -> DataFrame:
    """doc_id, the counts of the base rule, base_failed, rule (number of the rule that rejects, else null) and kept."""
    return _ruled(text_stats(docs), rules).select("doc_id", *(F.col(f"_{c}").alias(c) for c in COUNTS[:5]), "base_failed", "rule", "kept")


def _ruled(stats: DataFrame, rules: list[list[Test]]) -> DataFrame:
    """The verdict on rows with the counts: their other columns, the base counts as ``_<count>``, base_failed, rule and kept."""
    others = [c for c in stats.columns if c not in COUNTS]
    ratios = stats.select(*others, *(F.col(c).alias(f"_{c}") for c in COUNTS[:5]), _base_failed().alias("base_failed"), *statistic_columns())
    ruled = ratios.withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return ruled.select(*others, *(f"_{c}" for c in COUNTS[:5]), "base_failed", "rule", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))


def accepted(docs: DataFrame, rules: list[list[Test]]) -> DataFrame:
    """The documents, all columns, that the base rule and the list keep."""
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    return _ruled(counted(packed), rules).filter("kept").select("row.*")


def describe(rules: list[list[Test]]) -> list[str]:
    return [" and ".join(map(str, r)) for r in rules]
