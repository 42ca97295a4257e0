"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dbtelemetry.llm import common


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """``node, label`` for every node of ``links``; the label is the smallest node of its component.

    Every round takes the smallest label among a node's neighbours, then
    follows the label's own label; rounds end when nothing changes. Each
    round's labels are a table in the shared folder. Only the number of
    changes comes to the driver.
    """
    there = links.select(F.col(first).alias("node"), F.col(second).alias("other"))
    back = links.select(F.col(second).alias("node"), F.col(first).alias("other"))
    edges = common.stored(there.union(back).filter("node <> other").distinct())
    labels = common.stored(edges.groupBy("node").agg(F.least(F.first("node"), F.min("other")).alias("label")))
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"),
                                                 F.col("label").alias("old"))
        lower = common.stored(lower)
        own = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = common.stored(lower.join(own, "label").select("node", F.least("label", "next").alias("label"), "old"))
        changed = moved.filter("label <> old")
        labels = moved.select("node", "label")
        if common.is_empty(changed):
            return labels
