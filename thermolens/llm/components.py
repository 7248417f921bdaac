"""Connected components by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from thermolens.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node of it) for every node of an edge with two ends.

    ``edges`` has columns a and b of one ordered type. Each round hooks every node to its smallest
    neighbour, follows the hooks twice, and replaces nodes by what they hook to, so the edges
    shrink and a path of n nodes takes O(log n) rounds. A node with very many edges costs no more
    than others: minima are pre-aggregated, and joins are split by adaptive execution. Edges with
    a null end and loops are ignored; repeated edges count once. Every round is written to the
    shared folder.
    """
    rest = settle(edges.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not rest.isEmpty():
        ends = rest.select(F.col("b").alias("node"), F.col("a").alias("other")).union(
            rest.select("a", "b"))
        hook = settle(ends.groupBy("node").agg(F.min("other").alias("other")).select(
            "node", F.least("node", "other").alias("up")), "hooks")
        for _ in range(2):
            above = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hook = settle(hook.join(above, "up").select("node", F.col("top").alias("up")), "hooks")
        if labels is None:
            labels = hook.withColumnRenamed("up", "component")
        else:
            above = hook.select(F.col("node").alias("component"), "up")
            labels = settle(labels.join(above, "component", "left").select(
                "node", F.coalesce("up", "component").alias("component")), "labels")
        rest = settle(
            rest.join(hook.select(F.col("node").alias("a"), F.col("up").alias("c")), "a")
            .join(hook.select(F.col("node").alias("b"), F.col("up").alias("d")), "b")
            .filter("c <> d").select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
            .distinct(), "edges")
    if labels is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
