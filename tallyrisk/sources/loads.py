"""Loads of an append-only table: commit records, and an index of the stored keys.

    <target>/load=<id>/          the rows of a load
    <target>_rejects/load=<id>/  its rejected rows
    <target>/_commits/<n>.json   what the n-th commit did
    <target>/_keys/<name>/       a level of the key index, one folder a bucket

A load's rows and rejects count from the moment its commit record is there, and
both do.  A record is created under the next free number, or not at all: of two
writers one has to look again.  A load that died before its record is written
anew by the replay, in the same folders; one that has a record is not repeated.
The ids of a stream's epochs are ``<stream>@<epoch>``; an epoch up to the last one
committed is done.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.sources import files

#: Commits after which the whole state is written with a record, so that readers read no older ones.
SNAPSHOT_EVERY = 50
#: Most buckets of an index level.
MOST_BUCKETS = 1 << 14


def missing_path(error: AnalysisException) -> bool:
    return (error.getCondition() or "") == "PATH_NOT_FOUND"


def rejects_path(target: str) -> str:
    return f"{target.rstrip('/')}_rejects"


@dataclass
class State:
    """What the commits up to ``version`` left: loads that are read, ids that are done, levels of the key index."""

    version: int = 0
    loads: dict[str, dict] = field(default_factory=dict)     # id -> rows, rejects, low, high
    done: dict[str, dict] = field(default_factory=dict)      # id -> rows, rejects, of loads without an epoch
    epochs: dict[str, int] = field(default_factory=dict)     # stream -> last epoch
    levels: list[dict] = field(default_factory=list)         # name, buckets, loads
    adopted: bool = False                                    # files that stood in the table's folder before the first load

    def apply(self, record: dict) -> None:
        if "state" in record:
            for k, v in record["state"].items():
                setattr(self, k, v)
        elif "load" in record:
            self.loads[record["load"]] = record["facts"]
            stream, _, epoch = record["load"].rpartition("@")
            if stream:
                self.epochs[stream] = max(int(epoch), self.epochs.get(stream, -1))
            else:
                self.done[record["load"]] = {k: record["facts"][k] for k in ("rows", "rejects")}
            self.adopted |= record.get("adopted", False)
        elif "level" in record:
            self.levels = [level for level in self.levels if level["name"] not in record["replaced"]] + [record["level"]]
        elif "merged" in record:
            facts = {k: self.loads.pop(k) for k in record["replaced"]}
            self.loads[record["merged"]] = {
                "rows": sum(f["rows"] for f in facts.values()), "rejects": {},
                "low": min((f["low"] for f in facts.values() if f["low"] is not None), default=None),
                "high": max((f["high"] for f in facts.values() if f["high"] is not None), default=None)}
            for level in self.levels:
                if set(record["replaced"]) & set(level["loads"]):
                    level["loads"] = [k for k in level["loads"] if k not in record["replaced"]] + [record["merged"]]
        self.version = record["version"]

    def finished(self, load: str) -> dict | None:
        """The facts of a load that is done already."""
        stream, _, epoch = load.rpartition("@")
        if stream:
            return self.loads.get(load, {"rows": 0, "rejects": {}}) if int(epoch) <= self.epochs.get(stream, -1) else None
        return self.done.get(load)

    def indexed(self) -> set[str]:
        return {k for level in self.levels for k in level["loads"]}


class Loads:
    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")

    def path(self, load: str) -> str:
        return f"{self.target}/load={load}"

    def _commit_path(self, version: int) -> str:
        return f"{self.target}/_commits/{version:012}.json"

    def state(self, version: int | None = None) -> State:
        """The state now, or as of a version."""
        names = [n for n in files.names(self.spark, f"{self.target}/_commits") if n.endswith(".json")]
        numbers = sorted(n for n in (int(x[:-5]) for x in names) if version is None or n <= version)
        held = []
        for n in reversed(numbers):
            held.append(json.loads(files.read_text(self.spark, self._commit_path(n))))
            if "state" in held[-1]:
                break
        out = State()
        for record in reversed(held):
            out.apply(record)
        return out

    def commit(self, state: State, record: dict) -> bool:
        """Write the record that follows ``state``; False if another one has that number."""
        record = record | {"version": state.version + 1}
        if not files.create_once(self.spark, self._commit_path(record["version"]), json.dumps(record)):
            return False
        state.apply(record)
        if state.version % SNAPSHOT_EVERY == 0:
            kept = {k: v for k, v in vars(state).items() if k != "version"}
            files.create_once(self.spark, self._commit_path(state.version + 1),
                              json.dumps({"state": kept, "version": state.version + 1}))
        return True

    def _adopted(self) -> list[str]:
        return [f"{self.target}/{n}" for n in files.names(self.spark, self.target) if n.endswith(".parquet")]

    def begin(self) -> State:
        """The state to commit on; a table without records takes the files in its folder over."""
        state = self.state()
        if not state.version and not state.adopted:
            state.adopted = bool(self._adopted())
        return state

    def _read(self, loads: list[str], adopted: bool, rejects: bool = False) -> DataFrame | None:
        root = rejects_path(self.target) if rejects else self.target
        paths = [f"{root}/load={k}" for k in loads] + (self._adopted() if adopted else [])
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of all committed loads; a folder without any record is read as it is."""
        state = self.state(version)
        if not state.version:
            return self.spark.read.parquet(self.target)
        rows = self._read([k for k, f in state.loads.items() if f["rows"]], state.adopted)
        if rows is None:
            raise FileNotFoundError(f"no rows were loaded into {self.target}")
        return rows

    def rejects(self, version: int | None = None) -> DataFrame | None:
        """The rejected rows of all committed loads; None if there are none."""
        state = self.state(version)
        ids = files.names(self.spark, rejects_path(self.target))
        known = [k for k in (n.removeprefix("load=") for n in ids) if state.finished(k) is not None]
        return self._read(known, False, rejects=True)

    # --- keys ---------------------------------------------------------------

    def stored_keys(self, batch: DataFrame, key: list[str], state: State) -> DataFrame | None:
        """The batch's keys (distinct or not) that are stored already; None where none can be.

        Loads whose key range does not meet the batch's are not read.  Of the
        others those in the index are looked up in the buckets that the batch's
        keys fall into; only the key columns of the rest are read whole.
        """
        span = batch.agg(F.min(key[0]).cast("string").alias("low"), F.max(key[0]).cast("string").alias("high")).first()
        if span["low"] is None:
            return None
        near = {k for k, f in state.loads.items() if f["rows"] and _meet(f, span["low"], span["high"])}
        keys = batch.select(*key)
        found = []
        for level in state.levels:
            if near & set(level["loads"]):
                found.append(keys.join(self._level_keys(level, keys, key), key, "left_semi"))
        rest = self._read(sorted(near - state.indexed()), state.adopted)
        if rest is not None:
            low, high = (F.lit(span[k]).cast(batch.schema[key[0]].dataType) for k in ("low", "high"))
            found.append(keys.join(rest.filter(F.col(key[0]).between(low, high)).select(*key), key, "left_semi"))
        out = None
        for f in found:
            out = f if out is None else out.unionByName(f)
        return out

    def _level_keys(self, level: dict, keys: DataFrame, key: list[str]) -> DataFrame:
        """The level's keys in the buckets of the batch's keys (a level has at most MOST_BUCKETS)."""
        hit = [r[0] for r in keys.select(bucket_of(key, level["buckets"])).distinct().collect()]
        schema = T.StructType([T.StructField(k, keys.schema[k].dataType) for k in key] + [T.StructField("bucket", T.IntegerType())])
        stored = self.spark.read.schema(schema).parquet(f"{self.target}/_keys/{level['name']}")  # no file is read for it
        return stored.filter(F.col("bucket").isin(hit)).select(*key)

    def index(self, key: list[str], keys_per_bucket: int = 1_000_000, merge: bool = False) -> bool:
        """Add the loads that are in no level yet as a new one; ``merge``: all loads in one level.

        Keys are shuffled once, by bucket; a bucket is a folder with a file
        sorted by key.  False if there was nothing to add.
        """
        state = self.state()
        loads = [k for k, f in state.loads.items() if f["rows"] and (merge or k not in state.indexed())]
        if not loads:
            return False
        rows = sum(state.loads[k]["rows"] for k in loads)
        buckets = 1
        while buckets < MOST_BUCKETS and buckets * keys_per_bucket < rows:
            buckets *= 2
        name = uuid.uuid4().hex
        keys = self._read(loads, False).select(*key, bucket_of(key, buckets).alias("bucket"))
        keys.repartition("bucket").sortWithinPartitions("bucket", *key).write.partitionBy("bucket").parquet(
            f"{self.target}/_keys/{name}")
        record = {"level": {"name": name, "buckets": buckets, "loads": loads},
                  "replaced": [level["name"] for level in state.levels] if merge else []}
        while not self.commit(state, record):
            state = self.state()
        return True

    def merge_small(self, most_rows: int = 10_000_000) -> bool:
        """Rewrite the loads of at most ``most_rows`` rows as one; their ids stay done.  False if there are not two."""
        state = self.state()
        loads = [k for k, f in state.loads.items() if 0 < f["rows"] <= most_rows]
        if len(loads) < 2:
            return False
        merged = f"merged-{uuid.uuid4().hex}"
        self._read(loads, False).write.parquet(self.path(merged))
        record = {"merged": merged, "replaced": loads}
        while not self.commit(state, record):
            state = self.state()
            if not set(loads) <= set(state.loads):  # merged by another writer
                return False
        return True


def _meet(facts: dict, low: str, high: str) -> bool:
    """Whether a load's key range can hold keys from ``low`` to ``high`` (whole numbers as text; others may always)."""
    try:
        return int(facts["low"]) <= int(high) and int(low) <= int(facts["high"])
    except (TypeError, ValueError):
        return True


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).cast("int")
