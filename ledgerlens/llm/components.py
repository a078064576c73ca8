"""Connected components as joins: smallest label of the neighbours, then a jump to the label's label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import staged


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of the links ``a, b``.

    Every round halves the way to the smallest node at least on chains; each is written to
    the shared folder, so a lost executor repeats one round at most.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).where(F.col("a") != F.col("b"))
    both = staged(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    labels = staged(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        of_other = labels.select(F.col("node").alias("other"), F.col("component").alias("theirs"))
        near = both.join(of_other, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "theirs").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        new = staged(nearer.join(jump, "component", "left").select(
            "node", "was", F.least("component", F.coalesce("beyond", "component")).alias("component")), "labels")
        labels = new.select("node", "component")
        if new.where(F.col("was") != F.col("component")).isEmpty():
            return labels
