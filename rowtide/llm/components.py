"""Connected components of a graph of document ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import drop_table, materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for all ends of ``links`` (a, b).

    Each round gives every node the smallest label among its neighbours, then
    the label of its label, until nothing changes: about the logarithm of the
    longest shortest path. Rounds are tables in the shared folder, so a lost
    executor costs one round at most; the last two are kept. Neighbours' labels
    are minima of partial aggregates, and a node of very many links spreads
    over tasks in the joins, whose sides are both freshly dealt.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = materialize(both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))), "graph-links")
    first = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("other"))
    labels = materialize(first.select("node", F.least("node", "other").alias("component")), "graph-labels")
    while True:
        told = both.join(labels, both["u"] == labels["node"]).select(F.col("v").alias("node"), "component")
        near = labels.unionByName(told).groupBy("node").agg(F.min("component").alias("component"))
        near = materialize(near, "graph-near")
        over = near.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = near.join(over, "component", "left")
        now = materialize(
            jumped.select("node", F.least("component", F.coalesce("further", "component")).alias("component")),
            "graph-labels",
        )
        before = labels.select("node", F.col("component").alias("was"))
        changed = now.join(before, "node").filter("component < was").limit(1).count()
        drop_table(labels)
        drop_table(near)
        labels = now
        if not changed:
            return labels
