"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import Scratch

MAX_ROUNDS = 60


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, label (the smallest node reachable) for every node of ``links`` (a, b).

    Labels spread to neighbours and then jump to the label of the label, so that the rounds grow with
    the logarithm of the longest chain. Each round is a table in the shared folder. A node with many
    links spreads over tasks: minima are combined before the shuffle, and adaptive execution splits
    the join.
    """
    both = scratch.save(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), f"{name}-links")
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), f"{name}-0")
    for k in range(1, MAX_ROUNDS):
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "label")
        spread = near.unionByName(labels.select("node", "label")).groupBy("node").agg(F.min("label").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = scratch.save(spread.join(jump, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label")), f"{name}-{k}")
        before = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        after = new.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        scratch.drop(f"{name}-{k - 1}")
        labels = new
        if before == after:  # labels only ever fall
            return labels
    raise RuntimeError("components didn't settle")
