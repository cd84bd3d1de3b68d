"""Runs publish all their tables or none; counts come from the writing tasks; kept results."""

import tempfile

import pytest
from pyspark.sql import functions as F

from oracle.registry import AS_OF
from tallyrisk.plans import runs
from tallyrisk.sources.fixtures import bronze_frames
from tallyrisk.sources.results import ResultCache, normalised
from tallyrisk.sources.store import ConcurrentRunError, LayerStore


def new_store(spark, **args):
    return LayerStore(spark, tempfile.mkdtemp(prefix="tallyrisk-store-"), **args)


def numbers(spark, n, start=0):
    return spark.range(start, start + n).withColumnRenamed("id", "x")


def values(df):
    return sorted(r[0] for r in df.collect())


def jobs_of(spark, work):
    """(result, jobs that ran in a group of their own)."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_run_that_died_leaves_the_set_as_it_was(spark):
    store = new_store(spark)
    with store.run("v1") as run:
        run.publish("a", numbers(spark, 3))
        assert store.latest("a") is None  # not before the end
        run.publish("b", run.read("a").filter("x > 0"))
    with pytest.raises(RuntimeError):
        with store.run("v2") as run:
            run.publish("a", numbers(spark, 9))
            assert run.read("a").count() == 9 and run.read("b").count() == 2
            raise RuntimeError("killed")
    both = store.snapshot(["a", "b"])
    assert (values(both["a"]), values(both["b"])) == ([0, 1, 2], [1, 2])
    with store.run("v2") as run:  # the same version again: it was never published
        run.publish("a", numbers(spark, 5))
    assert store.read("a").count() == 5 and store.read("b").count() == 2
    assert store.snapshot(["a"], 2)["a"].count() == 3


def test_counts_and_observed_facts_without_reading(spark):
    store = new_store(spark)
    done = store.publish("t", numbers(spark, 100).withColumn("_even", F.col("x") % 2 == 0), "v1",
                         observe={"even": F.count_if("_even")}, hidden=("_even",))
    assert done == 100 and done.facts == {"rows": 100, "even": 50} and store.read("t").columns == ["x"]
    counts, jobs = jobs_of(spark, lambda: runs.verify(spark, store, ["t"]))
    assert jobs == 0 and [tuple(r) for r in counts.collect()] == [("t", 100)]
    assert not store.publish("t", numbers(spark, 0), "v2") and store.facts("t")["even"] == 50


def test_runs_at_the_same_time(spark):
    store = new_store(spark)
    store.publish("a", numbers(spark, 1), "v1")
    with store.run("v2") as one:
        one.publish("b", numbers(spark, 2))
        store.publish("c", numbers(spark, 3), "v1")       # another table: both stay
    assert store.read("b").count() == 2 and store.read("c").count() == 3
    with pytest.raises(ConcurrentRunError):
        with store.run("v3") as one:
            one.publish("b", one.read("a"))
            store.publish("a", numbers(spark, 7), "v4")   # what this run was made from
    assert store.read("a").count() == 7 and store.read("b").count() == 2


def test_expired_runs_keep_what_newer_ones_name(spark):
    store = new_store(spark, keep=2)
    store.publish("a", numbers(spark, 1), "v1")
    for n in range(4):
        store.publish("b", numbers(spark, n + 1), f"v{n}")
    assert store.read("a").count() == 1 and store.read("b").count() == 4
    assert store.marked("b") == "v3" and store.snapshot(["b"], 5)["b"].count() == 3
    with pytest.raises(Exception):
        store.read_version("b", "v1").count()


def test_a_killed_layer_run_and_matched_rows(spark, small_dir, monkeypatch):
    """Silver dies after customers and accounts: readers keep the old three; the bronze state is that of the manifest."""
    from tallyrisk.plans import silver
    from tallyrisk.sources.raw_files import with_lineage

    store, frames = new_store(spark), bronze_frames(spark, small_dir)
    for table, build in frames.items():
        with_lineage(build(), batch_id="b", source_file=table).write.parquet(runs.bronze_path(store, table))
    counts = {r.table_name: r.row_count for r in runs.run_silver(spark, store, AS_OF, version="v1").collect()}
    matched = frames["bronze_customers"]().join(frames["bronze_accounts"](), "customer_id", "left_semi").count()
    assert store.facts("silver_customers") == {"rows": counts["silver_customers"], "matched_rows": matched}
    before = {t: store.latest(t) for t in counts}

    def die(*args, **kwargs):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(silver, "silver_transactions", die)
        with pytest.raises(RuntimeError):
            runs.run_silver(spark, store, AS_OF, version="v2")
    assert {t: store.latest(t) for t in counts} == before
    with store.run("v3") as run:
        runs.run_silver(spark, store, AS_OF, run=run)
        runs.run_gold(spark, store, AS_OF, run=run)
        assert store.latest("silver_customers") == "v1"
    assert {store.latest(t) for t in (*counts, "gold_fraud_features")} == {"v3"}
    assert set(store.manifest()[1]["sources"]) == set(frames)


# --- kept results -----------------------------------------------------------

SQL = "SELECT x % 3 AS k, count(*) AS n FROM {t} WHERE x >= :low GROUP BY ALL ORDER BY n DESC, k"


def test_a_second_call_runs_no_job(spark):
    store, now = new_store(spark), [1000.0]
    store.publish("t", numbers(spark, 100), "v1")
    cache = ResultCache(store, max_age=60, clock=lambda: now[0])
    first, jobs = jobs_of(spark, lambda: cache.query(SQL, ["t"], {"low": 1}))
    assert jobs > 0
    want = [(0, 33), (1, 33), (2, 33)]
    assert [tuple(r) for r in first.collect()] == want
    other = ResultCache(LayerStore(spark, store.root), max_age=60, clock=lambda: now[0])  # another reader
    again, jobs = jobs_of(spark, lambda: other.query("  SELECT x % 3 AS k, /* three */ count(*) AS n FROM {t}\nWHERE x >= :low "
                                                     "GROUP BY ALL ORDER BY n DESC, k ; ", ["t"], {"low": 1}))
    assert jobs == 0 and [tuple(r) for r in again.collect()] == want and again.columns == ["k", "n"]
    _, jobs = jobs_of(spark, lambda: cache.query(SQL, ["t"], {"low": 2}))
    assert jobs > 0  # other parameters


def test_a_new_version_and_old_age_miss(spark):
    store, now = new_store(spark), [1000.0]
    store.publish("t", numbers(spark, 10), "v1")
    cache = ResultCache(store, max_age=60, clock=lambda: now[0])
    count = "SELECT count(*) AS n FROM {t}"
    assert cache.query(count, ["t"]).first()[0] == 10
    store.publish("t", numbers(spark, 20), "v2")
    assert cache.query(count, ["t"]).first()[0] == 20
    now[0] += 59
    assert jobs_of(spark, lambda: cache.query(count, ["t"]))[1] == 0
    now[0] += 2
    assert jobs_of(spark, lambda: cache.query(count, ["t"]))[1] > 0
    now[0] += 100
    assert cache.purge() == 2 and cache.query(count, ["t"]).first()[0] == 20
    empty = cache.query("SELECT x FROM {t} WHERE x < 0", ["t"])
    assert empty.count() == 0 and empty.columns == ["x"]


def test_statements_that_mean_the_same():
    assert normalised("select  1 -- one\n from t;") == normalised("select 1\tfrom t") == "select 1 from t"
    assert normalised("select 'a  b'") != normalised("select 'a b'")
    assert normalised("select '--x'") == "select '--x'" and normalised('select "a  b", `c  d`') == 'select "a  b", `c  d`'
    assert normalised("select 'it''s  ok'") == "select 'it''s  ok'"
