import zlib

import numpy as np
import pandas as pd
import pytest

from tallyrisk.llm.sharding import RoomTree, best_fit_decreasing, least_capacity, shard_documents


def brute_best_fit(items, capacity):
    """One group after the other, largest first, into the fullest bin with room."""
    bins = []
    for s in sorted(items, reverse=True):
        fits = [(room, i) for i, room in enumerate(bins) if room >= s]
        if fits:
            room, i = min(fits)
            bins[i] = room - s
        else:
            bins.append(max(capacity, s) - s)
    return bins


def test_runs_equal_group_by_group_placement():
    rng = np.random.default_rng(0)
    for _ in range(30):
        items = rng.integers(1, 60, rng.integers(1, 200)).tolist()
        sizes = sorted(set(items), reverse=True)
        counts = [items.count(s) for s in sizes]
        runs = best_fit_decreasing(sizes, counts, 100)
        room = {}
        for i, shard, k in runs:
            room[shard] = room.get(shard, 100) - k * sizes[i]
        assert sorted(room.values()) == sorted(brute_best_fit(items, 100))
        assert min(room.values()) >= 0


def test_room_tree_gives_the_tightest_fit():
    rng = np.random.default_rng(1)
    tree, held = RoomTree(), set()
    for k in range(500):
        tree.insert(r := int(rng.integers(0, 50)), k)
        held.add((r, k))
        size = int(rng.integers(0, 60))
        fits = [x for x in held if x[0] >= size]
        got = tree.take_tightest(size)
        assert got == (min(fits) if fits else None)
        held.discard(got)


def test_least_capacity_uses_no_more_shards():
    capacity, runs = least_capacity([9, 4, 3, 1], [3, 2, 5, 7], 4)
    assert max(r[1] for r in runs) <= 3 and capacity >= 57 // 4


def test_documents(spark, make):
    rng = np.random.default_rng(2)
    texts = ["x" * int(n) for n in rng.integers(0, 400, 150)] + ["copy " * 6] * 40 + [None, "", "é" * 10]
    docs = make(list(enumerate(texts)))
    got = shard_documents(docs, shards=8).toPandas().set_index("doc_id").sort_index()
    sizes = [len((t or "").encode()) + 1 for t in texts]
    assert got["size"].tolist() == sizes
    assert got["text_crc32"].tolist() == [zlib.crc32((t or "").encode()) for t in texts]
    load = got.groupby("shard")["size"].sum()
    assert sorted(load.index) == list(range(8)) and load.max() - load.min() <= max(sizes) * 2
    assert got.assign(t=[t or "" for t in texts]).groupby("t")["shard"].nunique().max() == 1
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    again = shard_documents(docs.repartition(5), shards=8).toPandas().set_index("doc_id").sort_index()
    assert (again["shard"] == got["shard"]).all()


def test_a_group_over_a_shard_is_split_evenly(spark, make):
    docs = make([(i, "the same text " * 5 if i % 3 else f"own text {i}" * 6) for i in range(300)])
    load = shard_documents(docs, shards=8).toPandas().groupby("shard")["size"].sum()
    assert len(load) == 8 and load.max() <= 1.2 * load.mean()


def test_capacity_nulls_repeats_and_empty(spark, make):
    docs = make([(1, "aaaa"), (1, "aaaa"), (None, "bb"), (2, None)]).withColumnRenamed("source", "shard")
    got = shard_documents(docs, capacity=10).toPandas()
    assert len(got) == 4 and (got.groupby("shard")["size"].sum() <= 10).all()
    assert shard_documents(docs.limit(0), shards=8).count() == 0
    with pytest.raises(ValueError):
        shard_documents(docs)
    assert isinstance(got, pd.DataFrame)
