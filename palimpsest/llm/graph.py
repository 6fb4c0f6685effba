"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import materialized


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for all nodes of ``edges`` (a, b); the label is the smallest node of the component.

    Each round takes the smallest label among neighbours and then the label of
    that label, so long chains halve from round to round.  Rounds are tables in
    the shared folder: a lost executor repeats one round at most.
    """
    both = materialized(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = materialized(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near")))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = step.join(labels.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left")
        new = materialized(jump.select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")))
        if new.where("label <> was").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
