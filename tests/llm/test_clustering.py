"""Orchard's search and the clustering against all distances in Python integers."""

import hashlib
import math

import numpy as np

from tallyrisk.llm.clustering import LONGEST, MOST, Neighbours, cluster_vectors, small, squared
from tallyrisk.llm.entries import op11_clustering


def brute(rows, clusters=16, rounds=3, components=64):
    """{position: (cluster, distance)}, and the final centroids, by all distances."""
    kept = {}
    for n, (_, v) in enumerate(rows):
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v):
            kept[n] = [max(-MOST, min(MOST, math.floor(64 * x))) for x in v]
    name = {n: hashlib.sha256(f"1:{'' if rows[n][0] is None else rows[n][0]}".encode()).hexdigest() for n in kept}
    centroids = [kept[n] for n in sorted(kept, key=lambda n: (name[n], kept[n]))[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for n, v in kept.items():
            members.setdefault(nearest(v)[1], []).append(v)
        for j, vs in members.items():
            centroids[j] = [sum(col) // len(vs) for col in zip(*vs)]
    return {n: nearest(v)[::-1] for n, v in kept.items()}, centroids


def check(spark, rows, **args):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<double>, id string, cluster int")
    want, centroids = brute(rows, **args)
    got = cluster_vectors(df, **args).collect()
    expected = sorted(((rows[n][0] is None, rows[n][0] or 0), c, min(d, LONGEST)) for n, (c, d) in want.items())
    assert sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["cluster"], r["distance"]) for r in got) == expected
    whole = sum(d for _, d in want.values())
    for r in got:
        assert r["centroid"] == centroids[r["cluster"]]
        assert r["cluster_inertia"] == min(LONGEST, sum(d for c, d in want.values() if c == r["cluster"]))
        assert r["inertia"] == min(LONGEST, whole)
    return got


def test_search_finds_the_nearest_and_the_smaller_of_ties():
    rng = np.random.default_rng(1)
    for spread in (2, 40, 4000):
        for k in (1, 2, 7, 16):
            centroids = rng.integers(-spread, spread + 1, (k, 5))
            centroids[k // 2] = centroids[0]
            x = rng.integers(-spread, spread + 1, (500, 5))
            apart = squared(x[:, None, :], centroids[None, :, :], True)
            best, distance = Neighbours(centroids).nearest(x)
            assert (best == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_search_asks_fewer_than_all(monkeypatch):
    """Separate groups: most centroids lie beyond twice the distance and are never measured."""
    rng = np.random.default_rng(2)
    centroids = rng.integers(-4000, 4000, (16, 8))
    x = centroids[rng.integers(0, 16, 2000)] + rng.integers(-20, 21, (2000, 8))
    search, asked = Neighbours(centroids), []
    plain = squared
    monkeypatch.setattr("tallyrisk.llm.clustering.squared", lambda a, c, f: (asked.append(len(a)), plain(a, c, f))[1])
    search.nearest(x)
    assert sum(asked) < 0.8 * 16 * len(x)


def test_large_numbers_are_exact():
    x = np.array([[1 << 62, -(1 << 62)], [3, 4]], np.int64)
    assert not small(x)
    best, distance = Neighbours(x).nearest(x + 0)
    assert best.tolist() == [0, 1] and [int(d) for d in distance] == [0, 0]
    assert int(squared(x[0], x[1], False)) == ((1 << 62) - 3) ** 2 + ((1 << 62) + 4) ** 2


def test_rounds_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(size=6) + 3 * (i % 5)).tolist()) for i in range(400)]
    rows += [(7, rows[7][1])] * 3 + [(None, rows[9][1])]
    check(spark, rows, clusters=9, components=6)


def test_left_out_rows_ties_few_rows_and_extremes(spark):
    ok = [0.5, -0.25, 1.0]
    rows = [(1, ok), (2, None), (3, [0.1, None, 0.2]), (4, [0.1, float("nan"), 0.2]), (5, [float("inf"), 0.0, 0.0]),
            (6, [1.0]), (7, []), (8, ok), (9, [-0.001, 0.001, 0.0]), (10, [1e300, -1e300, 5.0])]
    got = check(spark, rows, clusters=16, components=3)
    assert {r["vec_id"] for r in got} == {1, 8, 9, 10}
    assert not check(spark, [(2, None)], components=3)
    empty = cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_entry_columns(spark, small_dir):
    got = op11_clustering(spark, small_dir)
    assert got.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"),
                          ("inertia", "bigint"), ("centroid_sha256", "string")]
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    want, centroids = brute(rows)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    assert {r["vec_id"]: (r["cluster"], r["distance"], r["centroid_sha256"]) for r in got.collect()} == {
        rows[n][0]: (c, d, digest[c]) for n, (c, d) in want.items()}
