"""Sharding: best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts enter, largest first, the fullest shard that still has
room; the open shards stand in a balanced tree by remaining room.

Scale.  Groups of one size are interchangeable, so the packing runs on the
histogram of group sizes.  It is bounded: sizes are rounded up to 16
significant bits, which makes at most 2**16 + 48 * 2**15 (about 1.6 million)
classes however large the input is.  A run of equal groups is placed at once,
because after taking one the tightest shard stays the tightest.  Everything
that grows with the data (digests, groups, ranks in a class, slots) stays in
shuffles keyed by digest or by (class, block), so no class, shard or group of
copies ever meets in one task.

Defined cases: null text has size 1 and shares its group with the empty text;
equal rows get slots of their own; an empty table gives an empty result; a
group larger than a shard can't be indivisible, and is cut into pieces of at
most a quarter of a shard; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, stored

BITS = 16


class RoomTree:
    """Shards by (remaining room, number) in a treap: insert, take the tightest fit."""

    def __init__(self) -> None:
        self.root: list | None = None
        self._random = random.Random(7)

    def insert(self, room: int, shard: int) -> None:
        low, high = self._split(self.root, (room, shard))
        self.root = self._merge(self._merge(low, [(room, shard), self._random.random(), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the least (room, shard) with room >= size."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        first = high
        while first[2] is not None:
            first = first[2]
        _, rest = self._split(high, (first[0][0], first[0][1] + 1))
        self.root = self._merge(low, rest)
        return first[0]

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Nodes with keys below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            node[3] = low
            return node, high
        low, high = self._split(node[2], key)
        node[2] = high
        return low, node

    def _merge(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a if b is None else b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b


def best_fit_decreasing(sizes: list[int], counts: list[int], capacity: int,
                        most: int | None = None) -> list[tuple[int, int, int]] | None:
    """Runs (class index, shard, number of groups) for classes given largest first.

    Exactly the placement of one group after the other.  A group above the
    capacity gets a shard of its own.  None once more than ``most`` shards are
    open.
    """
    tree, runs, shards = RoomTree(), [], 0
    for i, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        while count:
            if (found := tree.take_tightest(size)) is None:
                if shards == most:
                    return None
                found = (max(capacity, size), shards)
                shards += 1
            room, shard = found
            k = min(count, room // size)
            runs.append((i, shard, k))
            count -= k
            tree.insert(room - k * size, shard)
    return runs


def least_capacity(sizes: list[int], counts: list[int], shards: int) -> tuple[int, list[tuple[int, int, int]]]:
    """The smallest capacity found by bisection at which best fit decreasing needs at most ``shards`` shards."""
    total = sum(s * c for s, c in zip(sizes, counts, strict=True))
    low = max(-(-total // shards), sizes[0])
    if (runs := best_fit_decreasing(sizes, counts, low, shards)) is not None:
        return low, runs
    high, step = low, max(1, low // 4096)
    while (runs := best_fit_decreasing(sizes, counts, high, shards)) is None:
        low, high, step = high, high + step, step * 2
    while high - low > max(1, low >> 18):
        middle = (low + high) // 2
        if (found := best_fit_decreasing(sizes, counts, middle, shards)) is None:
            low = middle
        else:
            high, runs = middle, found
    return high, runs


def size_class(size: Column) -> Column:
    """``size`` rounded up to 16 significant bits."""
    unit = F.pow(F.lit(2), F.greatest(F.lit(0), F.length(F.bin(size)) - BITS)).cast("long")
    return F.floor((size + unit - 1) / unit).cast("long") * unit


def shard_documents(docs: DataFrame, shards: int | None = None, capacity: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's shard: ``doc_id``, ``size``, ``text_crc32``, ``group_bytes``, ``shard``, ``slot``.

    Give ``capacity`` (bytes; as few shards as best fit decreasing needs) or
    ``shards`` (the least capacity at which that many are enough, so that they
    end up nearly equal).  Size: UTF-8 bytes of the text plus 1.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest")), "shard-rows")
    spark = docs.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = capacity if capacity is not None else max(1, total // shards)

    # Groups that no shard can hold: fewer than total / limit of them.
    groups = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("size").alias("size"))
    groups = groups.withColumn("bytes", F.col("n") * F.col("size"))
    big = [bytes(r[0]) for r in groups.filter((F.col("bytes") > limit) & (F.col("n") > 1)).select("digest").collect()]
    if big:
        is_big = F.col("digest").isin(big)
        pieces = gapless_rank(rows.filter(is_big), ["digest"], ["doc_id"], "copy")
        each = F.greatest(F.lit(1), F.floor(F.lit(limit / 4) / F.col("size")))
        rows = stored(rows.filter(~is_big).withColumn("part", F.lit(0).cast("long")).unionByName(
            pieces.withColumn("part", F.floor(F.col("copy") / each).cast("long")).drop("copy")), "shard-parts")
    else:
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    items = rows.groupBy("digest", "part").agg((F.count("*") * F.min("size")).alias("group_bytes"))
    items = stored(items.withColumn("class", size_class(F.col("group_bytes"))), "shard-groups")

    histogram = items.groupBy("class").count().orderBy(F.desc("class")).toPandas()  # bounded, see above
    sizes, counts = histogram["class"].tolist(), histogram["count"].tolist()
    if not sizes:
        runs = []
    elif shards is not None:
        _, runs = least_capacity(sizes, counts, shards)
    else:
        runs = best_fit_decreasing(sizes, counts, capacity)
    index, shard, number = (np.array(x, dtype=np.int64) for x in (zip(*runs) if runs else ([], [], [])))
    table = pd.DataFrame({"class": np.array(sizes, dtype=np.int64)[index], "shard": shard, "n": number})
    table["hi"] = table.groupby("class")["n"].cumsum()
    table["lo"] = table["hi"] - table["n"]
    table = spark.createDataFrame(table[["class", "shard", "lo", "hi"]],
                                  "class_r long, shard long, lo long, hi long")
    if len(runs) <= 100_000:  # beyond, a shuffled join
        table = F.broadcast(table)
    placed = gapless_rank(items, ["class"], ["digest", "part"], "rank").join(
        table, (F.col("class") == F.col("class_r")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    placed = stored(placed.select(F.col("digest").alias("digest_r"), F.col("part").alias("part_r"),
                                  "group_bytes", F.col("shard").cast("int").alias("shard")), "shard-placed")
    # One row a group on the right, none aggregated in between: a hot group's rows are split by the skew join.
    rows = rows.join(placed, (F.col("digest") == F.col("digest_r")) & (F.col("part") == F.col("part_r")))
    rows = stored(rows.select("doc_id", "size", "text_crc32", "group_bytes", "shard"), "shard-documents")
    return gapless_rank(rows, ["shard"], ["doc_id", "text_crc32"], "slot")
