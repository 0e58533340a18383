"""Connected components of a large graph, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node of an edge.

    `edges` has `src` and `dst`. In each round a node takes the smallest label of its neighbours
    and then the label of that label, so paths halve; the labels are settled, and the rounds end
    when no label changes. A hub's edges are combined by a partial minimum before the shuffle and
    its label is read by a join that splits skewed keys. Loops and repeated edges change nothing.
    """
    both = settle(edges.select("src", "dst").union(edges.select("dst", "src"))
                  .where("src != dst").distinct())
    labels = settle(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low"))
                    .select("node", F.least("node", "low").alias("component")))
    while True:
        offered = both.join(labels, F.col("src") == F.col("node")).groupBy("dst").agg(
            F.min("component").alias("offer"))
        lower = labels.join(offered, F.col("node") == F.col("dst")).select(
            "node", F.col("component").alias("old"),
            F.least("component", "offer").alias("component"))
        known = labels.select(F.col("node").alias("at"), F.col("component").alias("jump"))
        jumped = settle(lower.join(known, F.col("component") == F.col("at")).select(
            "node", "old", F.least("component", "jump").alias("component")))
        labels = jumped.select("node", "component")
        if jumped.where("component != old").isEmpty():
            return labels
