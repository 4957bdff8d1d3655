"""Connected components of a link table, by distributed label spreading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import stage, unstage


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``.

    ``component`` is the smallest node reachable. Each round takes, per node,
    the smallest label among itself and its neighbours, then replaces labels by
    the label of the label (pointer jumping), so a chain of n nodes needs about
    log n rounds. Labels are pre-aggregated before each shuffle and the table is
    staged each round; only a changed-row count reaches the driver. Self links
    and repeated links are harmless; null ends are dropped.
    """
    spark = links.sparkSession
    links = links.where("a is not null and b is not null")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, both_path = stage(both, "links")
    labels, path = stage(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("seen")))
        lower = labels.join(near, "node").select(
            "node", F.least("component", "seen").alias("to"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("jumped"))
        now, now_path = stage(
            lower.join(jump, "to", "left").select(
                "node", F.least(F.col("to"), F.coalesce("jumped", "to")).alias("component"), "was"), "labels")
        changed = now.where("component <> was").limit(1).count()
        unstage(spark, path)
        labels, path = now.select("node", "component"), now_path
        if not changed:
            unstage(spark, both_path)
            return labels
