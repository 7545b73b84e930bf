"""Connected components by spreading the smallest label, with pointer jumping; all of it in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, gathered, keep

#: Labels of a task, where they are few.
LABELS = 1 << 14


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of edges (a, b): label is the smallest node it is connected with. The result is kept.

    Each round takes the least label among a node's neighbours, then that label's own label, so long chains shrink to
    half and stars take two rounds. A node with very many edges is pre-aggregated in the grouping, and a skewed key of
    the join, which adaptive execution splits.
    """
    both = keep(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "component-edges")
    rows = both.count()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
    labels = keep(gathered(labels, rows, LABELS), "component-labels")
    for _ in range(rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("least"))
        spread = labels.join(near, labels["node"] == near["a"], "left").select("node", F.least("label", "least").alias("next"), "label")
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        after = spread.join(jump, spread["next"] == jump["_n"], "left").select("node", F.least("next", "_l").alias("label"), (F.least("next", "_l") != F.col("label")).alias("changed"))
        after = keep(gathered(after, rows, LABELS), "component-labels")
        moving = after.where("changed").limit(1).count()
        drop(labels)
        labels = after
        if not moving:
            break
    else:
        raise RuntimeError(f"labels still change after {rounds} rounds")
    drop(both)
    return labels.select("node", "label")
