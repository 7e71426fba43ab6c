"""Connected components of an edge list by iterative joins with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.cut import materialize


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) links -> (node, component), component being the smallest node of the group.

    Each round lowers every node's label to the smallest among its neighbours and then follows the label
    of its label, so long chains need a logarithmic number of rounds. Links are reduced to distinct ones,
    the aggregation over a node's neighbours combines before it moves, and labels are written to the
    shared folder after every round. Nulls and loops are left out; no edges give no rows. If ``rounds``
    did not suffice an error is raised, never a partial result.
    """
    e = edges.select("a", "b").filter("a is not null and b is not null and a <> b")
    both = materialize(e.union(e.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        low = labels.join(near, "node").select("node", F.least("component", "c").alias("low"), "component")
        root = labels.select(F.col("node").alias("low"), F.col("component").alias("up"))
        step = low.join(root, "low", "left").select("node", F.least("low", "up").alias("component"), (F.least("low", "up") != F.col("component")).alias("moved"))
        step = materialize(step, "labels")
        labels = step.select("node", "component")
        if step.filter("moved").isEmpty():
            return labels
    raise RuntimeError(f"components not settled after {rounds} rounds")
