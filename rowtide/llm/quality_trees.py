"""Histogram gradient-boosted trees over text statistics.

The statistics are column expressions over whole texts. The trees are fitted
on a bounded sample of labelled rows (``FIT_ROWS`` rows of twelve numbers)
with numpy: features are cut into at most 64 bins, and each level of a tree is
one pass of gradient and Hessian histograms per node and bin. The ensemble is
flattened into arrays ``feature, threshold, value`` of complete binary trees,
which Arrow batches are walked through level by level without branches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import fold_of, labelled, materialize
from rowtide.llm.text_stats import FEATURES, ratios, text_counts
from rowtide.session import ship

FIT_ROWS = 50_000
TREES = 40
DEPTH = 4
BINS = 64
RATE = 0.2
RIDGE = 1.0
CUTOFF = 0.3


@dataclass(frozen=True)
class Trees:
    """Complete trees: node ``i`` has children ``2i+1`` and ``2i+2``."""

    prior: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); go right if x > threshold
    value: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(len(value)))):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - len(feature)]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost the logistic loss. Without rows the score is 0.5 everywhere."""
    inner, leaves = 2**depth - 1, 2**depth
    rate = (y.sum() + 1.0) / (len(y) + 2.0)
    prior = float(np.log(rate / (1 - rate)))
    empty = Trees(prior, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(y) == 0 or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    total = np.full(len(y), prior)
    out = []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        gradient, hessian = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            split_bin = np.full(width, BINS)
            for f, c in enumerate(cuts):
                cell = (node - first) * BINS + bins[:, f]
                g = np.bincount(cell, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(cell, hessian, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + RIDGE) + (gt - g) ** 2 / (ht - h + RIDGE) - gt**2 / (ht + RIDGE)
                gain = gain[:, : len(c)]
                if not gain.size:
                    continue
                at = gain.argmax(axis=1)
                now = gain[np.arange(width), at]
                better = now > best
                best = np.where(better, now, best)
                split_bin = np.where(better, at, split_bin)
                nodes = first + np.flatnonzero(better)
                feature[nodes], threshold[nodes] = f, c[at[better]]
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > split_bin[node - first])
        leaf = node - inner
        value = -np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, hessian, leaves) + RIDGE)
        total += RATE * value[leaf]
        out.append((feature, threshold, RATE * value))
    f, t, v = (np.stack(part) for part in zip(*out, strict=True))
    return Trees(prior, f, t, v)


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Learns from at most about ``fit_rows`` labelled rows outside fold 0. An
    empty or null text is scored from its zero counts. Repeated rows get equal
    scores; a row without id is scored and counts as not held out.
    """
    ship(docs.sparkSession)
    counts = materialize(text_counts(docs), "text-counts")
    named = [v.alias(k) for k, v in ratios().items()]
    fit = counts.join(F.broadcast(labelled(labels, "quality", fit_rows)), "doc_id").select("label", *named).toPandas()
    fit = fit.sort_values(list(fit.columns))  # the order of the rows must not matter
    model = fit_trees(fit[list(FEATURES)].to_numpy(float), (fit["label"].to_numpy() > 0).astype(float))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(model.score(x.astype(float)))], ["doc_id", "score"]
            )

    kind = counts.schema["doc_id"].dataType.simpleString()
    scored = counts.select("doc_id", *named).mapInArrow(walk, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )
