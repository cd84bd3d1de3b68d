"""Links inside bounded groups, and the units in which candidates meet."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.operators.joins import estimated_bytes

#: Rows and bytes of files up to which a stored table is broadcast instead of shuffled against.
SMALL_ROWS = 200_000
SMALL_BYTES = 16 << 20


def spanning_links(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges that span the components: ``linked(i, others)`` tells which of ``others`` node i is linked with.

    Every node asks once, for the nodes not reached yet, so each pair that
    could still join two components is decided, and at most n - 1 edges come out.
    """
    edges = []
    left = np.arange(n)
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            yes = linked(i, left)
            reached = left[yes]
            left = left[~yes]
            edges += [(i, int(j)) for j in reached]
            queue += reached.tolist()
    return edges


def units(candidates: DataFrame, regions: DataFrame, most: int) -> DataFrame:
    """(unit, node): every candidate component (node, root, weight) of up to ``most`` in weight is a unit.

    Of larger ones the regions (region, node) that the candidates came from
    are, each bounded already.
    """
    sizes = candidates.groupBy("root").agg(F.sum("weight").alias("weight"))
    large = sizes.filter(F.col("weight") > most).select("root")
    if large.isEmpty():
        return candidates.select(F.col("root").alias("unit"), "node")
    within = candidates.join(large, "root").select("node")
    return candidates.join(large, "root", "left_anti").select(F.col("root").alias("unit"), "node").unionByName(
        regions.join(within, "node").select(F.unhex(F.hex("region")).alias("unit"), "node"))


def small(df: DataFrame) -> DataFrame:
    """A stored table within both bounds marked for broadcast; any other as it is."""
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= SMALL_BYTES and df.count() <= SMALL_ROWS else df
