"""Duplicate keys by merged counters against plain counts."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from tallyrisk.operators import quality
from tallyrisk.operators.quality import _packed, _unpacked, duplicate_keys, key_counters


def plain(df, cols):
    dup = df.groupBy(*cols).count().filter("count > 1").collect()
    return len(dup), sum(r["count"] for r in dup)


def found(tables, keys, **args):
    return {r["table_name"]: (r["duplicate_keys"], r["duplicate_rows"]) for r in duplicate_keys(tables, keys, **args).collect()}


KEYS = {"clean": ["a"], "hot": ["a"], "pair": ["a", "b"], "nulls": ["a"], "empty": ["a"]}


def tables(spark):
    rnd = random.Random(3)
    pair = [(rnd.randint(0, 60), rnd.choice(["x", "y", None])) for _ in range(200)]
    return {"clean": spark.range(20_000).withColumnRenamed("id", "a").repartition(8),
            "hot": spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("a")).repartition(8),
            "pair": spark.createDataFrame(pair, "a int, b string"),
            "nulls": spark.createDataFrame([(None,), (None,), ("",), ("v",)], "a string"),
            "empty": spark.createDataFrame([], "a long")}


@pytest.mark.parametrize("colliding", [False, True])
def test_counters_give_the_plain_counts(spark, colliding):
    """Also where hashes collide: the keys themselves decide."""
    t = tables(spark)
    args = {"key_hash": lambda *c: F.pmod(F.xxhash64(*c), F.lit(500))} if colliding else {}
    assert found(t, KEYS, **args) == {n: plain(t[n], cols) for n, cols in KEYS.items()}


def test_clean_tables_shuffle_no_keys(spark):
    """What is exchanged: a row a task and part, of a few bytes a key; a hot key is one hash a task."""
    rows = spark.range(200_000).select(F.lit(0).alias("t"), F.xxhash64("id").alias("h")).repartition(4)
    put = rows.mapInArrow(lambda b: key_counters(b, 3), "t int, part long, once binary, twice binary").collect()
    assert len(put) == 4 * 8 and all(r["twice"] is None for r in put)
    assert sum(len(r["once"]) for r in put) < 8 * 200_000
    hot = spark.range(100_000).select(F.lit(0).alias("t"), F.xxhash64(F.lit(1)).alias("h")).repartition(4)
    put = hot.mapInArrow(lambda b: key_counters(b, 3), "t int, part long, once binary, twice binary").collect()
    assert len(put) == 4 and all(len(_unpacked(r["once"])) == 1 and len(_unpacked(r["twice"])) == 1 for r in put)


def test_put_out_early_gives_the_same(spark, monkeypatch):
    rng = np.random.default_rng(1)
    h = rng.integers(-2**63, 2**63 - 1, 1000)
    h = np.concatenate([h, h[:30]])
    batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(len(x), np.int32)), pa.array(x)], ["t", "h"]) for x in np.split(h, 5 * 2)]

    def result():
        parts = pa.Table.from_batches(key_counters(iter(batches), 2))
        return {x for p in range(4) for x in quality.met_twice(parts.filter(pa.compute.equal(parts["part"], p)))["h"].to_pylist()}

    want = result()
    assert want == set(h[:30].tolist())
    monkeypatch.setattr(quality, "HELD_HASHES", 150)
    assert result() == want


def test_packed_hashes_come_back():
    for x in ([0], [1, 2, 2**64 - 1], [2**63]):
        x = np.array(x, np.uint64)
        assert (_unpacked(_packed(x)) == x).all()
