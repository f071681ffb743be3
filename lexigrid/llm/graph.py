"""Connected components of an edge table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.plans.session import materialize

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for the nodes of ``(a long, b long)``: the least node of each component.

    In a round every node takes the least label among its neighbours' and then the label of that label, so a
    chain of length n needs about log n rounds. Labels are written after each round; the joins meet two written
    tables, so that a node with very many neighbours can be split over tasks.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.filter("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        told = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        near = materialize(told, "near")
        met = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        met = materialize(met, "met")
        up = met.select(F.col("node").alias("new"), F.col("new").alias("up"))
        after = met.join(up, "new").select("node", F.least("new", "up").alias("label"), (F.least("new", "up") < F.col("label")).alias("moved"))
        after = materialize(after, "labels")
        labels = after.select("node", "label")
        if not after.filter("moved").limit(1).count():
            return labels
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
