"""Learned decision lists over text statistics.

Sequential covering: a rule is a conjunction of thresholds. It grows on two
thirds of the labelled rows, one condition at a time, by the gain in
information about the rejected class; it is pruned on the other third to the
prefix with the best margin; what it covers is set aside and the next rule
grows on the rest. The list is emitted as one ordered ``CASE WHEN`` expression,
so applying it is a projection without Python.

Every growing step is one grouped count over binned rows; the driver sees only
counts per feature and bin.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import pairwise

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.functions.settle import settled
from rowtide.llm.common import labelled, materialize
from rowtide.llm.text_stats import COUNTS, FEATURES, ratios, text_counts

FIT_ROWS = 50_000
BINS = 24
MAX_RULES = 8
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVER = 5
MIN_WORDS = 20
MAX_REPEATED = 30


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = ratios()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules that reject; what none covers is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def verdict(self) -> Column:
        """Text of the first rule that covers a row of counts, or null."""
        out = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            every = rule[0].column()
            for c in rule[1:]:
                every = every & c.column()
            out = F.when(every, " and ".join(map(str, rule))).otherwise(out)
        return out


def base_failed() -> Column:
    """Too short, or too much of it repeated."""
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def learn_rules(counts: DataFrame, fit: DataFrame) -> DecisionList:
    """Learn what to reject from ``counts`` joined to the labels ``fit`` (0: reject).

    ``fit`` is bounded (see :func:`common.labelled`), so it is broadcast. Rows
    that the base rule rejects are not learned from. Without labels, or with
    one class only, the list is empty and keeps everything.
    """
    named = [v.alias(k) for k, v in ratios().items()]
    rows = counts.join(F.broadcast(fit), "doc_id").filter(~base_failed())
    rows = rows.select("label", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3)).alias("fold"), *named)
    rows = materialize(rows, "rules-fit")
    at = [i / BINS for i in range(1, BINS)] + [0.98, 0.99, 0.995]
    found = rows.agg(*[F.percentile_approx(f, sorted(at), 2_000).alias(f) for f in FEATURES]).first()
    # Half way between neighbouring quantiles: a rule keeps its distance from both sides.
    cuts = {f: [(a + b) / 2 for a, b in pairwise(sorted(set(found[f] or [])))] for f in FEATURES}
    bins = F.array(*[sum(((F.col(f) > c).cast("int") for c in cuts[f]), F.lit(0)) for f in FEATURES])
    binned = materialize(rows.select("label", "fold", bins.alias("bins")), "rules-bins")

    def holds(condition: Condition) -> Column:
        i, cut = FEATURES.index(condition.feature), cuts[condition.feature].index(condition.threshold)
        return F.col("bins")[i] > cut if condition.above else F.col("bins")[i] <= cut

    def whole(rule: list[Condition]) -> Column:
        every = F.lit(True)
        for c in rule:
            every = every & holds(c)
        return every

    reject = (F.col("label") == 0).cast("long")
    open_rows, out = binned, DecisionList()
    while len(out.rules) < MAX_RULES:
        rule = _grow(open_rows.filter("fold > 0"), cuts, holds)
        if not rule:
            break
        prefixes = [whole(rule[:k]) for k in range(1, len(rule) + 1)]
        sums = [F.sum(F.when(p, reject)).alias(f"p{k}") for k, p in enumerate(prefixes)]
        sums += [F.sum(F.when(p, 1 - reject)).alias(f"n{k}") for k, p in enumerate(prefixes)]
        tried = open_rows.groupBy((F.col("fold") == 0).alias("held")).agg(*sums).collect()
        held = next((r for r in tried if r["held"]), None)
        margin = []
        for k in range(len(rule)):
            p, n = ((held[f"{c}{k}"] or 0) if held else 0 for c in "pn")
            margin.append((p - n) / (p + n) if p + n else -1.0)
        size = max(range(len(rule)), key=lambda k: (margin[k], -k)) + 1
        p, n = (sum(r[f"{c}{size - 1}"] or 0 for r in tried) for c in "pn")
        if p < MIN_COVER or p / (p + n) < MIN_PRECISION or margin[size - 1] < 2 * MIN_PRECISION - 1:
            break
        out.rules.append(rule[:size])
        open_rows = open_rows.filter(~prefixes[size - 1])
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]], holds) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        cells = (
            rows.select("label", F.posexplode("bins").alias("f", "bin"))
            .groupBy("f", "bin", "label")
            .count()
            .collect()
        )
        by = {f: [[0, 0] for _ in range(len(cuts[f]) + 1)] for f in FEATURES}
        for c in cells:
            by[FEATURES[c["f"]]][c["bin"]][c["label"] != 0] += c["count"]
        p_all, n_all = (sum(x[i] for x in by[FEATURES[0]]) for i in (0, 1))
        if not p_all or not n_all:
            break
        before = math.log2(p_all / (p_all + n_all))
        best, best_gain = None, 1e-9
        for f in FEATURES:
            p_low = n_low = 0
            for cut, (p, n) in zip(cuts[f], by[f], strict=False):
                p_low, n_low = p_low + p, n_low + n
                for above, ps, ns in ((False, p_low, n_low), (True, p_all - p_low, n_all - n_low)):
                    gain = ps * (math.log2(ps / (ps + ns)) - before) if ps else 0.0
                    if gain > best_gain:
                        best, best_gain = Condition(f, above, cut), gain
        if best is None:
            break
        rule.append(best)
        rows = rows.filter(holds(best))
    return rule


def judge(counts: DataFrame, rules: DecisionList) -> DataFrame:
    """``counts`` with ``base_failed``, ``rule`` (the covering rule's text) and ``kept``."""
    return counts.withColumns({"base_failed": base_failed(), "rule": rules.verdict()}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Counts and verdict per row of ``docs``; the text is read once.

    A null or empty text has no words and fails the base rule. Repeated rows
    are judged alike; rows without an id are judged but not learned from.
    """
    counts = materialize(text_counts(docs), "text-counts")
    return judge(counts, learn_rules(counts, labelled(labels, "quality", fit_rows)))


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all their columns unchanged.

    Extra columns of any name pass through, since the row travels as one struct.
    """
    fit = labelled(labels, "quality", fit_rows)
    seen = docs.select("doc_id", "text").join(F.broadcast(fit.select("doc_id")), "doc_id", "left_semi")
    rules = learn_rules(materialize(text_counts(seen), "text-counts"), fit)
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    # Final counts: the filter below must not repeat the expressions that make them.
    counts = settled(text_counts(packed, keep=("row",)), *COUNTS)
    return judge(counts, rules).filter("kept").select("row.*")
