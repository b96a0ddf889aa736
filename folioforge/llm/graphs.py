"""Connected components of links that no single machine could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, comp (the least node reachable) for every node that has a link; links: a, b.

    Each round takes every node to the least label among its neighbours and then to its
    label's label, which halves long chains; it ends when a round changes nothing.  The
    joins have the links on their large side and are split by Spark where a node has very
    many; links and labels are written, so no round depends on the files of the last.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.table(both.distinct(), f"{name}-links")
    labels = scratch.table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("other")), "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        low = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "other").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        after = low.join(jump, "comp", "left").select("node", "old", F.least("comp", "next").alias("comp"))
        after = scratch.table(after, f"{name}-{step}")
        if after.where("comp <> old").isEmpty():
            return after.select("node", "comp")
        labels = after.select("node", "comp")
        if step > 1:
            scratch.drop(f"{name}-{step - 2}")
