"""Classes of linked nodes: every node takes the smallest label around it, and labels jump to their own labels.

A round sends each edge's labels to both of its ends (the smallest wins, combined before the shuffle), hooks the label
that lost onto the winner, and then follows pointers until they stand on roots. Edges inside of one class are dropped, the
others go on between classes, so the edge table shrinks from round to round. Nothing is held per node or per class.

Edge cases: links with a null end, or to itself, say nothing; repeated links count once; no links give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.session import materialize


def _roots(parents: DataFrame) -> DataFrame:
    """``parents(node, label)`` with every label followed to its root; roots are no rows of it."""
    while True:
        up = parents.select(F.col("node").alias("_n"), F.col("label").alias("_up"))
        jumped = parents.join(up, F.col("label") == F.col("_n"), "left").select("node", F.coalesce("_up", "label").alias("label"), F.col("_up").isNotNull().alias("moved"))
        jumped = materialize(jumped)
        if jumped.where("moved").isEmpty():
            return jumped.select("node", "label")
        parents = jumped.select("node", "label")


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(u, v)``; the label is the smallest node of its class."""
    edges = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    labels = None
    while not edges.isEmpty():
        parents = _roots(materialize(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))))
        new = parents.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        if labels is None:
            labels = parents
        else:
            moved = labels.join(new, F.col("label") == F.col("_n"), "left").select("node", F.coalesce("_l", "label").alias("label"))
            labels = moved.unionByName(parents.join(labels.select("node"), "node", "left_anti"))
        labels = materialize(labels)
        ends = edges.join(new, F.col("u") == F.col("_n"), "left").select(F.coalesce("_l", "u").alias("u"), "v")
        ends = ends.join(new, F.col("v") == F.col("_n"), "left").select("u", F.coalesce("_l", "v").alias("v"))
        edges = materialize(ends.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
