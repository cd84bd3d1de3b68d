"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); roots name the components.

    Every round gives each node the least of its neighbours and itself, and
    contracts the edges to these names, until none is left.  Node ids should be
    hashes: then about a third of the nodes are local minima and the rounds
    are logarithmic in the longest path, whatever the shape of a component.
    A hot node costs nothing special: minima are combined map-side, and the
    joins' right sides hold one row a node in stored tables, so that the skew
    join can split the left ones.  Each round is stored in the shared folder.
    """
    live = stored(edges.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("up")), "parents")
        if labels is None:
            labels = least.select("node", F.col("up").alias("root"))
        else:
            moved = least.select(F.col("node").alias("root"), F.col("up").alias("next"))
            labels = stored(labels.join(moved, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "labels")
        one = least.select(F.col("node").alias("a"), F.col("up").alias("a2"))
        two = least.select(F.col("node").alias("b"), F.col("up").alias("b2"))
        live = live.join(one, "a").join(two, "b").filter(F.col("a2") != F.col("b2"))
        live = stored(live.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
    if labels is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
