"""Centroid clustering of integer vectors, nearest centroids by Orchard's search.

A component x becomes the integer floor(64 x).  Rows with exactly ``components``
components, none null or not finite, are clustered, all others are left out.
Components beyond 2**62 in size count as 2**62; distances and inertias that no
long holds are the greatest long.

Every round is one scan: the tasks search each vector's nearest centroid and
add up counts and component sums by cluster, Spark merges these (clusters x
components rows), and the driver gets the new centroids.  The last assignment
is stored, and the inertias are sums over it.

Defined results: null vectors, null or non-finite components and other lengths
are left out; a null id counts as the empty text when the first centroids are
chosen and is returned as null; repeated rows are clustered each for itself;
equal hashes (repeated ids) go by the components; fewer vectors than clusters
give as many centroids as there are vectors; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_array, ship_package, slices, stored

MOST = 1 << 62
#: Sizes below this keep every squared distance of 64 components in a long.
SMALL = 1 << 27
LONGEST = (1 << 63) - 1


def integer_vectors(vectors: pa.Array, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(indexes of the rows kept, their integer components)."""
    lists = vectors.cast(pa.large_list(pa.float64()))
    right = np.asarray(lists.value_lengths().fill_null(-1)) == components
    rows = np.flatnonzero(right)
    flat = lists.take(pa.array(rows)).flatten()
    known = np.asarray(flat.is_valid()).reshape(len(rows), components)
    x = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(rows), components)
    whole = known.all(axis=1) & np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(x[whole] * 64.0), -float(MOST), float(MOST))
    return rows[whole], scaled.astype(np.int64)


def small(x: np.ndarray) -> bool:
    return bool(np.abs(x).max(initial=0) < SMALL)


def squared(x: np.ndarray, c: np.ndarray, fits: bool) -> np.ndarray:
    """Squared distances along the last axis, exact: in longs where ``fits``, else in Python integers."""
    if fits:
        d = x - c
        return np.einsum("...i,...i->...", d, d)
    d = x.astype(object) - c.astype(object)
    return (d * d).sum(axis=-1)


class Neighbours:
    """For each centroid the others in the order of their distance from it (ties: smaller number first)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.fits = small(centroids)
        n = len(centroids)
        apart = squared(centroids[:, None, :], centroids[None, :, :], self.fits)
        self.lists = np.zeros((n, max(n - 1, 0)), np.int64)
        for i in range(n):
            self.lists[i] = [j for j in sorted(range(n), key=lambda j: (apart[i, j], j)) if j != i]
        self.apart = np.take_along_axis(apart, self.lists, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (ties: the smaller number) and squared distance of every vector.

        All vectors walk at once, each along the list of its best centroid so
        far.  A closer one that is met (or an equally close one of smaller
        number) becomes the best, and the walk goes on at the head of its list;
        centroids measured before are marked and passed over.  A vector is done
        at the end of a list, or where a neighbour stands strictly beyond twice
        the vector's current distance (squared: four times), for by the
        triangle inequality no later one is closer or as close.
        """
        n, k = len(x), len(self.centroids)
        fits = self.fits and small(x)
        best = np.zeros(n, np.int64)
        distance = squared(x, self.centroids[best], fits)
        marked = np.zeros((n, k), bool)
        marked[:, 0] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n if k > 1 else 0)
        while len(walking):
            at = best[walking], place[walking]
            walking = walking[self.apart[at] <= 4 * distance[walking]]
            other = self.lists[best[walking], place[walking]]
            place[walking] += 1
            new = ~marked[walking, other]
            asks, other = walking[new], other[new]
            marked[asks, other] = True
            found = squared(x[asks], self.centroids[other], fits)
            closer = (found < distance[asks]) | ((found == distance[asks]) & (other < best[asks]))
            moved = asks[closer]
            best[moved], distance[moved], place[moved] = other[closer], found[closer], 0
            walking = walking[place[walking] < k - 1]
        return best, distance


def _batches(batches: Iterator[pa.RecordBatch], components: int):
    for b in slices(batches, 4000):
        rows, x = integer_vectors(b.column("vector"), components)
        if len(rows):
            yield b.column("id").take(pa.array(rows)), x


def first_centroids(vectors: DataFrame, clusters: int, components: int, seed: int) -> np.ndarray:
    """The kept vectors with the smallest sha256 of ``seed:id``, in that order (ties: by the vectors)."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = vectors.filter(F.col("vector").isNotNull() & (F.size("vector") == components) & finite)
    few = first.orderBy(name, "vector").limit(clusters).select("vector").toArrow()
    return integer_vectors(flat_array(few["vector"]), components)[1]


def moved_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid with vectors replaced by floor(sum / count) of their components."""
    search, (k, components) = Neighbours(centroids), centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(k, np.int64)
        total = np.zeros((k, components), object)
        for _, x in _batches(batches, components):
            best, _ = search.nearest(x)
            count += np.bincount(best, minlength=k)
            numbers = x if small(x) else x.astype(object)
            for c in np.unique(best):
                total[c] += numbers[best == c].sum(axis=0)
        clusters, places = np.divmod(np.arange(k * components), components)
        totals = pa.array([Decimal(int(v)) for v in total.ravel()], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(clusters), pa.array(places), pa.array(np.repeat(count, components)), totals],
            ["cluster", "place", "rows", "total"])

    parts = vectors.mapInArrow(sums, "cluster long, place long, rows long, total decimal(38,0)")
    merged = parts.groupBy("cluster", "place").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
    out = centroids.copy()
    for r in merged.filter("rows > 0").collect():  # clusters x components rows at most
        out[r["cluster"], r["place"]] = int(r["total"]) // r["rows"]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector kept."""
    search, components = Neighbours(centroids), centroids.shape[1]
    kind = vectors.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _batches(batches, components):
            best, distance = search.nearest(x)
            if distance.dtype == object:
                distance = np.array([min(d, LONGEST) for d in distance], np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best.astype(np.int32)), pa.array(distance)],
                                             ["id", "cluster", "distance"])

    return vectors.mapInArrow(assign, f"id {kind}, cluster int, distance long")


def cluster_vectors(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", clusters: int = 16,
                    rounds: int = 3, components: int = 64, seed: int = 1) -> DataFrame:
    """One row a kept vector: id, cluster, distance, cluster_inertia, inertia, centroid (array of longs)."""
    spark = ship_package(table.sparkSession)
    vectors = table.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    centroids = first_centroids(vectors, clusters, components, seed)
    if not len(centroids):
        return _nothing(vectors, id_column)
    for _ in range(rounds):
        centroids = moved_centroids(vectors, centroids)
    last = stored(assigned(vectors, centroids), "assigned")
    by_cluster = {r["cluster"]: int(r["total"]) for r in last.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole = min(sum(by_cluster.values()), LONGEST)
    rows = [(c, min(total, LONGEST), whole, centroids[c].tolist()) for c, total in by_cluster.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return last.join(F.broadcast(facts), "cluster").select(  # one row a cluster
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def _nothing(vectors: DataFrame, id_column: str) -> DataFrame:
    return vectors.limit(0).select(
        F.col("id").alias(id_column), *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"),
            ("centroid", "array<long>"))])
