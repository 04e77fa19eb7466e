"""Learned decision lists over text statistics.

Sequential covering: a rule grows by the threshold condition with the best information gain on two thirds of the labelled
rows, is pruned on the other third, and the rows it covers leave before the next rule grows. Every step is one
aggregation into (feature, bin) counts, so the driver sees features x bins rows whatever the size of the table. The result
is an ordered list that turns into one Spark conditional expression.

Defined cases: rows without a label don't train; a null statistic meets no condition; with no labelled rows, or none of
one class, the list is empty and rejects nothing. Candidate thresholds lie midway between neighbouring class quantiles,
equal gains are settled by feature order, then by the lower threshold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.common import bounded_sample, uniform
from topicweave.llm.text_stats import COUNTS, SHARES, one_row_each, with_statistics
from topicweave.session import materialize


#: Statistics that don't drift with a text's length; the share of distinct words does, so no rule is learned from it.
RULE_FEATURES = tuple(s for s in SHARES if s != "distinct_share")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        met = F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold
        return F.coalesce(met, F.lit(False))

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    hits: int = 0
    misses: int = 0

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [c.column() for c in self.conditions], F.lit(True))

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass
class DecisionList:
    """Rules in order; the first that a row meets names the reason for its rejection."""

    rules: list[Rule] = field(default_factory=list)

    def reason(self) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            out = F.when(rule.column(), F.lit(str(rule))).otherwise(out)
        return out

    def rejects(self) -> Column:
        return reduce(lambda a, b: a | b, [r.column() for r in self.rules], F.lit(False))


@dataclass(frozen=True)
class Learning:
    """``sample`` bounds the labelled rows used; ``precision`` is what a rule must reach on the rows kept for pruning."""

    sample: int = 50_000
    max_rules: int = 8
    max_conditions: int = 3
    bins: int = 24
    precision: float = 0.95
    support: int = 3
    seed: int = 11


def learn(labelled: DataFrame, features: Sequence[str], label: str, key: str = "doc_id", how: Learning = Learning()) -> DecisionList:
    """Rules that single out the rows whose ``label`` is true."""
    rows = labelled.where(F.col(label).isNotNull()).select(
        F.col(label).cast("boolean").alias("_hit"), (uniform(F.col(key), seed=how.seed) < 2 / 3).alias("_grow"), *features, F.col(key).alias("_key"),
    )
    rows = materialize(bounded_sample(rows, "_key", how.sample, how.seed + 1), "labelled")
    cuts = _thresholds(rows, features, how.bins)
    found = DecisionList()
    while len(found.rules) < how.max_rules:
        left = rows.where(~found.rejects())
        rule = _prune(left.where(~F.col("_grow")), _grow(left.where("_grow"), cuts, how))
        if rule is None or rule.hits < how.support or rule.hits < how.precision * (rule.hits + rule.misses):
            break
        found.rules.append(rule)
    return found


def _thresholds(rows: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Midpoints between the quantiles of the two classes."""
    marks = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    per_class = rows.groupBy("_hit").agg(*[F.percentile_approx(f, marks, 10_000).alias(f) for f in features]).collect()
    out = {}
    for f in features:
        values = sorted({float(v) for r in per_class for v in (r[f] or [])})
        out[f] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]], how: Learning) -> Rule:
    bin_of = {
        f: reduce(lambda a, b: a + b, [(F.col(f) > c).cast("int") for c in cut], F.lit(0)) for f, cut in cuts.items() if cut
    }
    rule = Rule(())
    if not bin_of:
        return rule
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), b.alias("bin")) for f, b in bin_of.items()]))
    while len(rule.conditions) < how.max_conditions:
        counts: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in bin_of}
        table = rows.where(rule.column()).select(cells.alias("cell"), "_hit").groupBy("cell.feature", "cell.bin")
        for r in table.agg(F.count_if("_hit").alias("p"), F.count_if(~F.col("_hit")).alias("n")).collect():
            if r["bin"] is not None:
                counts[r["feature"]][r["bin"]] = (r["p"], r["n"])
        best = _best_condition(counts, cuts)
        if best is None:
            break
        rule = Rule((*rule.conditions, best[0]))
        if best[1] == 0:
            break
    return rule


def _best_condition(counts, cuts) -> tuple[Condition, int] | None:
    """The condition with the highest gain, and how many rows of the other class it leaves."""
    best, top = None, 1e-9
    for feature, cells in counts.items():
        p_all, n_all = sum(p for p, _ in cells.values()), sum(n for _, n in cells.values())
        if not p_all or not n_all:
            continue
        prior, p_low, n_low = math.log2(p_all / (p_all + n_all)), 0, 0
        for b, cut in enumerate(cuts[feature]):
            p, n = cells.get(b, (0, 0))
            p_low, n_low = p_low + p, n_low + n
            for above, hit, miss in ((False, p_low, n_low), (True, p_all - p_low, n_all - n_low)):
                if hit and (gain := hit * (math.log2(hit / (hit + miss)) - prior)) > top:
                    best, top = (Condition(feature, above, cut), miss), gain
    return best


def _prune(rows: DataFrame, rule: Rule) -> Rule | None:
    """The beginning of the rule that separates the kept rows best; the shorter one of equals."""
    if not rule.conditions:
        return None
    starts = [Rule(rule.conditions[: k + 1]) for k in range(len(rule.conditions))]
    got = rows.agg(*[
        x.alias(f"{kind}{k}") for k, s in enumerate(starts)
        for kind, x in (("p", F.count_if(F.col("_hit") & s.column())), ("n", F.count_if(~F.col("_hit") & s.column())))
    ]).collect()[0]
    scored = [((got[f"p{k}"] - got[f"n{k}"]) / max(1, got[f"p{k}"] + got[f"n{k}"]), -k) for k in range(len(starts))]
    k = -max(scored)[1]
    return Rule(starts[k].conditions, got[f"p{k}"], got[f"n{k}"])


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> DataFrame:
    """Statistics and verdict of every row of ``docs``; rules are learned from ``labels (doc_id, quality)``, 0 for junk.

    Returns ``doc_id``, COUNTS, ``base_failed``, ``kept``, ``reason`` (the first rule met), SHARES and ``text_digest``, which tells
    rows of one id apart. Of a labelled id with several texts the one with the least digest trains.
    """
    stats = materialize(with_statistics(docs), "statistics")
    junk = labels.where("quality in (0, 1)").groupBy("doc_id").agg((F.min("quality") == 0).alias("junk"))
    # what the base rules reject anyway teaches nothing
    known = one_row_each(stats.where(~base_failed()).join(junk, "doc_id"))
    rules = learn(known, RULE_FEATURES, "junk", how=how)
    return stats.select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & ~rules.rejects()).alias("kept"),
        rules.reason().alias("reason"), *SHARES, "text_digest",
    )
