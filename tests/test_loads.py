"""Loads count once, as a whole, whatever dies in between; stored keys are found without reading what can't hold them."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyrisk.schemas import RAW_SCHEMAS
from tallyrisk.sources import files, loads as loads_module
from tallyrisk.sources.loads import Loads, State
from tallyrisk.sources.raw_files import RAW, REASONS, DuplicateKeyError, append_checked

TABLE, KEY = "bronze_accounts", ["account_id"]
SCHEMA = RAW_SCHEMAS[TABLE]


def target():
    return os.path.join(tempfile.mkdtemp(prefix="tallyrisk-loads-"), TABLE)


def batch(spark, ids, load="l", bad=()):
    """One row an id (None: no key); ids in ``bad`` did not parse."""
    df = spark.createDataFrame([(i,) for i in ids], "account_id long").withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in SCHEMA.fields if f.name != "account_id"})
    wrong = F.col("account_id").isin(list(bad)) if bad else F.lit(False)
    return df.withColumns({"batch_id": F.lit(load),
                           REASONS: F.when(wrong, F.array(F.lit("no number"))).otherwise(F.array().cast("array<string>")),
                           RAW: F.lit(None).cast("map<string,string>")})


def ids(df):
    return sorted(r["account_id"] for r in df.select("account_id").collect())


def outcome(spark, path):
    log = Loads(spark, path)
    lost = log.rejects()
    reasons = [] if lost is None else sorted((r["account_id"] or 0, r[REASONS][0]) for r in lost.collect())
    return ids(log.read()), reasons


def test_a_replayed_load_changes_nothing(spark):
    path = target()
    first = append_checked(batch(spark, [1, 2, 3]), path, TABLE, mode="skip", load_id="s@0")
    second = append_checked(batch(spark, [3, 4, 4, None, 9], bad=[9]), path, TABLE, mode="skip", load_id="s@1")
    assert (first, second) == (3, 1)
    want = outcome(spark, path)
    assert want == ([1, 2, 3, 4], [(0, "missing key"), (3, "stored key"), (4, "repeated key"), (9, "no number")])
    for load, rows in (("s@1", [3, 4, 4, None, 9]), ("s@0", [1, 2, 3])):
        again = append_checked(batch(spark, rows), path, TABLE, mode="skip", load_id=load)
        assert again in (0, 1, 3) and outcome(spark, path) == want
    assert append_checked(batch(spark, [1]), path, TABLE, mode="skip", load_id="t@0") == 0  # another stream
    plain = append_checked(batch(spark, [7, 7]), path, TABLE, mode="skip", load_id="nightly")
    replay = append_checked(batch(spark, [7, 7]), path, TABLE, mode="skip", load_id="nightly")
    assert plain == replay == 1 and plain.rejects == replay.rejects == {"repeated key": 1}


@pytest.mark.parametrize("dies_at", ["rejects", "commit"])
def test_a_load_that_died_is_invisible_and_run_again(spark, monkeypatch, dies_at):
    path = target()
    append_checked(batch(spark, [1, 2]), path, TABLE, mode="skip", load_id="a")
    want_before = outcome(spark, path)

    class Died(Exception):
        pass

    def die(*args, **kwargs):
        raise Died

    with monkeypatch.context() as m:
        if dies_at == "commit":
            m.setattr(Loads, "commit", die)
        else:  # the rows are written, the rejects are not
            m.setattr("tallyrisk.sources.raw_files.rejects_path", die)
        with pytest.raises(Died):
            append_checked(batch(spark, [2, 3, None]), path, TABLE, mode="skip", load_id="b")
    assert os.path.exists(f"{path}/load=b")
    assert outcome(spark, path) == want_before
    assert append_checked(batch(spark, [2, 3, None]), path, TABLE, mode="skip", load_id="b") == 1
    assert outcome(spark, path) == ([1, 2, 3], [(0, "missing key"), (2, "stored key")])


def test_a_load_committed_in_between_is_checked_again(spark, monkeypatch):
    path = target()
    append_checked(batch(spark, [1]), path, TABLE, mode="skip", load_id="a")
    plain, other = Loads.commit, []

    def late(self, state, record):
        if not other:
            other.append(True)
            append_checked(batch(spark, [2, 3]), path, TABLE, mode="skip", load_id="other")
        return plain(self, state, record)

    monkeypatch.setattr(Loads, "commit", late)
    assert append_checked(batch(spark, [3, 4]), path, TABLE, mode="skip", load_id="b") == 1
    assert outcome(spark, path) == ([1, 2, 3, 4], [(3, "stored key")])


def test_fail_mode_writes_nothing(spark):
    path = target()
    for rows in ([1, 1], [None]):
        with pytest.raises(DuplicateKeyError):
            append_checked(batch(spark, rows), path, TABLE)
        assert not os.path.exists(path)
    assert append_checked(batch(spark, [1]), path, TABLE) == 1
    with pytest.raises(DuplicateKeyError):
        append_checked(batch(spark, [5, 1]), path, TABLE)
    with pytest.raises(ValueError):
        append_checked(batch(spark, [6]), path, TABLE, load_id="a/b")
    assert ids(Loads(spark, path).read()) == [1]


def test_files_from_before_the_first_load_are_kept(spark):
    path = target()
    batch(spark, [1, 2]).drop(REASONS, RAW).write.parquet(path)
    assert append_checked(batch(spark, [2, 3]), path, TABLE, mode="skip", load_id="a") == 1
    assert ids(Loads(spark, path).read()) == [1, 2, 3]
    assert Loads(spark, path).index(KEY)
    assert append_checked(batch(spark, [1, 3, 4]), path, TABLE, mode="skip", load_id="b") == 1


def spoil(folder):
    """Files that can't be read any more."""
    for root, _, names in os.walk(folder):
        for n in names:
            with open(os.path.join(root, n), "w") as fh:
                fh.write("spoilt")


def test_files_without_the_keys_are_not_read(spark):
    path = target()
    append_checked(batch(spark, range(0, 4000, 2)), path, TABLE, load_id="even")
    append_checked(batch(spark, range(100_000, 100_100)), path, TABLE, load_id="far")
    log = Loads(spark, path)
    assert log.index(KEY, keys_per_bucket=100) and not log.index(KEY, keys_per_bucket=100)
    level = log.state().levels[0]
    assert level["buckets"] == 32
    kept = {r[0] for r in spark.createDataFrame([(i,) for i in (4, 5, 7)], "account_id long").select(
        loads_module.bucket_of(KEY, 32)).collect()}
    for bucket in set(range(32)) - kept:
        spoil(f"{path}/_keys/{level['name']}/bucket={bucket}")
    for load in ("even", "far"):
        spoil(f"{path}/load={load}")
    fresh = append_checked(batch(spark, [4, 5, 7]), path, TABLE, mode="skip", load_id="odd")
    assert fresh == 2 and fresh.rejects == {"stored key": 1}
    with pytest.raises(Exception):  # these keys' buckets are spoilt
        append_checked(batch(spark, range(1000)), path, TABLE, mode="skip", load_id="all")
    # Beyond all key ranges nothing is read at all.
    spoil(f"{path}/_keys")
    assert append_checked(batch(spark, [200_000]), path, TABLE, mode="skip", load_id="new") == 1


def test_levels_and_merged_loads_answer_the_same(spark):
    path = target()
    log = Loads(spark, path)
    for n in range(4):
        append_checked(batch(spark, [10 * n + i for i in range(8)]), path, TABLE, mode="skip", load_id=f"s@{n}")
        if n < 2:
            assert log.index(KEY, keys_per_bucket=2)
    before = log.state().version
    assert log.merge_small() and not log.merge_small()
    assert log.index(KEY, merge=True, keys_per_bucket=3) and len(log.state().levels) == 1
    got = append_checked(batch(spark, [0, 9, 17, 31, 39]), path, TABLE, mode="skip", load_id="s@4")
    assert got == 2 and got.rejects == {"stored key": 3}
    assert append_checked(batch(spark, [0]), path, TABLE, mode="skip", load_id="s@2") == 0  # done, though merged
    assert len(ids(log.read())) == 34 and len(ids(log.read(before))) == 32


def test_state_from_snapshots(spark, monkeypatch):
    monkeypatch.setattr(loads_module, "SNAPSHOT_EVERY", 3)
    path = target()
    log = Loads(spark, path)
    for n in range(7):
        state = log.state()
        assert log.commit(state, {"load": f"s@{n}", "facts": {"rows": 0, "rejects": {}, "low": None, "high": None}})
        assert log.commit(State(version=state.version - 1), {"load": "late", "facts": {}}) is False
    names = files.names(spark, f"{path}/_commits")
    assert any("state" in files.read_text(spark, f"{path}/_commits/{n}") for n in names if n.endswith(".json"))
    state = log.state()
    assert sorted(state.loads) == [f"s@{n}" for n in range(7)] and state.epochs == {"s": 6}
    assert state.finished("s@3") is not None and state.finished("s@7") is None and state.finished("other") is None


def test_a_key_in_a_third_of_the_batch(spark):
    """Of a hot repeated key one row stays; the others are rejected, whole."""
    path = target()
    got = append_checked(batch(spark, [0] * 3000 + list(range(1, 6001))).repartition(8), path, TABLE, mode="skip", load_id="a")
    assert got == 6001 and got.rejects == {"repeated key": 2999}
