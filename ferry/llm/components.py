"""Connected components of a link table, by label propagation with pointer
jumping. Every round is a join and a partially aggregated minimum, written to
the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.plans.sizing import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of every node of ``links`` (columns a, b): the label
    is the smallest node of its component."""
    both = materialize(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node"))
                         .agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        seen = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        moved = labels.join(seen, "node").select("node", F.least("label", "near").alias("label"), 
                                                 F.col("label").alias("was"))
        moved = materialize(moved, "labels")
        roots = moved.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = materialize(moved.join(roots, "label", "left")
                             .select("node", F.least("label", "root").alias("label"), "was"), "labels")
        if jumped.filter("label <> was").limit(1).count() == 0:
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
