"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b): comp is the smallest node that links reach.

    Each round takes the least label of all neighbours and then the label of that label, so chains halve;
    hot nodes meet only joins and partial aggregates. Every round is written out; it ends when no label changes.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = stage(both.distinct())
    # The first round needs no labels: everybody's label is the node itself.
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")))
    while True:
        own = labels.select(F.col("node").alias("n"), F.col("comp").alias("c"))
        near = both.join(own, both["b"] == own["n"]).groupBy("a").agg(F.min("c").alias("m"))
        merged = labels.join(near, labels["node"] == near["a"], "left")
        merged = stage(merged.select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp")))
        jump = merged.select(F.col("node").alias("n"), F.col("comp").alias("c"))
        after = merged.join(jump, merged["comp"] == jump["n"], "left")
        after = stage(after.select("node", "old", F.least("comp", "c").alias("comp")))
        labels = after.select("node", "comp")
        if not after.where("comp <> old").limit(1).count():
            return labels
