"""Data quality checks as Spark jobs: counts, NULLs, keys, orphans, lengths.

Most checks are one aggregate per table (partial-combined before the
shuffle) whose results are unioned; nothing is collected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.operators.joins import join_dimension
from tallyrisk.schemas import FOREIGN_KEYS, NULL_CHECKS, PRIMARY_KEYS, VARCHAR_LIMITS
from tallyrisk.session import ship_package, stored


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """One (table_name, row_count) row per table."""
    return _union([tables[n].agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(n).alias("table_name"), "row_count") for n in names])


def null_checks(tables: dict[str, DataFrame], checks=NULL_CHECKS) -> DataFrame:
    """NULL count per (table, column) with pass/warn status.

    One aggregate (one scan) per table, whatever the number of columns checked.
    """
    by_table: dict[str, list[str]] = {}
    for table, column in checks:
        by_table.setdefault(table, []).append(column)
    frames = []
    for table, columns in by_table.items():
        wide = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
        frames.append(wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)")
                      .select(F.lit(table).alias("table_name"), "column_name", "null_count"))
    out = _union(frames)
    return out.withColumn("status", F.when(F.col("null_count") == 0, "pass").otherwise("warn"))


#: Key hashes that a task holds before it puts them out.
HELD_HASHES = 4_000_000


def _packed(hashes: np.ndarray) -> bytes:
    """Sorted distinct hashes as compressed differences, high bytes first."""
    gaps = np.diff(hashes, prepend=np.uint64(0))
    return zlib.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(gaps).view(np.uint64).ravel(), dtype=np.uint64)


def key_counters(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(t, h) to (t, part, once, twice): the distinct hashes of the task's keys, and those met more than once.

    Saturating counters: however often a key comes, it is one hash here.
    ``part``: the first ``bits`` bits of the hashes.
    """
    held: dict[int, list[np.ndarray]] = {}
    number = 0

    def put() -> Iterator[pa.RecordBatch]:
        rows = []
        for t, parts in held.items():
            once, count = np.unique(np.concatenate(parts), return_counts=True)
            part = (once >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(once), np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            for low, high in zip(cuts, np.append(cuts[1:], len(once)), strict=True):
                many = once[low:high][count[low:high] > 1]
                rows.append((t, int(part[low]), _packed(once[low:high]), _packed(many) if len(many) else None))
        held.clear()
        if rows:
            t, part, once, twice = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(part, pa.int64()), pa.array(once, pa.binary()),
                                              pa.array(twice, pa.binary())], ["t", "part", "once", "twice"])

    for b in batches:
        t, h = b.column("t").to_numpy(), b.column("h").to_numpy().view(np.uint64)
        for one in np.unique(t):
            held.setdefault(int(one), []).append(h[t == one])
        number += len(h)
        if number >= HELD_HASHES:
            yield from put()
            number = 0
    yield from put()


def met_twice(part: pa.Table) -> pa.Table:
    """The hashes that one part's counters, of all tasks, met more than once."""
    once = np.sort(np.concatenate([_unpacked(b) for b in part["once"].to_pylist()]))
    found = [once[1:][once[1:] == once[:-1]], *[_unpacked(b) for b in part["twice"].to_pylist() if b is not None]]
    hashes = np.unique(np.concatenate(found)).view(np.int64)
    return pa.table({"t": pa.array(np.full(len(hashes), part["t"][0].as_py()), pa.int32()), "h": pa.array(hashes)})


def duplicate_keys(tables: dict[str, DataFrame], keys=PRIMARY_KEYS, key_hash=F.xxhash64) -> DataFrame:
    """Q05: number of key values that occur more than once, per table.

    Keys are not shuffled.  Tasks put out the hashes of their keys, sorted,
    as compressed differences; these are merged, and only keys whose hash was
    met twice are gathered and counted as they are.  A table without
    duplicates is read once.  The merging job runs at once.
    """
    names = [t for t in keys if t in tables]
    spark = ship_package(tables[names[0]].sparkSession)
    bits = max(0, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())
    rows = _union([tables[t].select(F.lit(n).alias("t"), key_hash(*keys[t]).alias("h"),
                                    F.array(*[F.col(c).cast("string") for c in keys[t]]).alias("k")) for n, t in enumerate(names)])
    counters = rows.select("t", "h").mapInArrow(lambda b: key_counters(b, bits), "t int, part long, once binary, twice binary")
    doubtful = stored(counters.groupBy("t", "part").applyInArrow(met_twice, "t int, h long"), "doubtful-keys")
    listed = spark.createDataFrame([(n, t, ",".join(keys[t])) for n, t in enumerate(names)], "n int, table_name string, key_columns string")
    none = F.lit(0).cast("long")
    if doubtful.isEmpty():
        return listed.select("table_name", "key_columns", none.alias("duplicate_keys"), none.alias("duplicate_rows"))
    counted = join_dimension(rows, doubtful, ["t", "h"], "left_semi").groupBy("t", "k").count().filter(F.col("count") > 1)
    found = counted.groupBy("t").agg(F.count(F.lit(1)).alias("duplicate_keys"), F.sum("count").alias("duplicate_rows"))
    return listed.join(found, F.col("n") == F.col("t"), "left").select(
        "table_name", "key_columns", *[F.coalesce(c, none).alias(c) for c in ("duplicate_keys", "duplicate_rows")])


def orphan_rows(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent (anti join, no pairs built; parent keys as they are)."""
    keys = parent.select(F.col(parent_col).alias("_k"))
    return (child.filter(F.col(child_col).isNotNull())
            .join(keys, F.col(child_col) == F.col("_k"), "left_anti"))


def foreign_key_orphans(tables: dict[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """Q06: orphan count per foreign key.

    A child is read once for all its foreign keys and counted by (foreign key,
    value), map-side, so a hot key is one row by the time it is joined.  Only
    these counts meet the parents' keys, each parent being read once.
    """
    fks = [f for f in fks if f[0] in tables and f[2] in tables]
    parents = list(dict.fromkeys((parent, pcol) for _, _, parent, pcol in fks))
    counts = []
    for child in dict.fromkeys(f[0] for f in fks):
        refs = F.array(*[F.struct(F.lit(n).alias("_fk"), F.lit(parents.index((parent, pcol))).alias("_parent"),
                                  F.col(ccol).cast("bigint").alias("_v"))
                         for n, (c, ccol, parent, pcol) in enumerate(fks) if c == child])
        counts.append(tables[child].select(F.explode(refs).alias("_p")).select("_p.*").filter(F.col("_v").isNotNull())
                      .groupBy("_fk", "_parent", "_v").agg(F.count(F.lit(1)).alias("_n")))
    keys = _union([tables[parent].select(F.lit(n).alias("_k"), F.col(pcol).cast("bigint").alias("_kv"))
                   for n, (parent, pcol) in enumerate(parents)])
    # An outer join and a test, as an anti join would be copied into every branch of the union, parents included.
    lost = _union(counts).join(keys, (F.col("_parent") == F.col("_k")) & (F.col("_v") == F.col("_kv")), "left").filter(
        F.col("_kv").isNull())
    totals = lost.agg(*[F.coalesce(F.sum(F.when(F.col("_fk") == n, F.col("_n"))), F.lit(0)).alias(f"_{n}")
                        for n in range(len(fks))])
    rows = F.array(*[F.struct(F.lit(child).alias("child_table"), F.lit(ccol).alias("child_column"),
                              F.lit(parent).alias("parent_table"), F.col(f"_{n}").alias("orphan_rows"))
                     for n, (child, ccol, parent, _) in enumerate(fks)])
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def length_violations(tables: dict[str, DataFrame], limits=VARCHAR_LIMITS) -> DataFrame:
    """Q13: values longer than the contract's VARCHAR(n), per (table, column)."""
    frames = []
    for table, cols in limits.items():
        if table not in tables:
            continue
        aggs = [F.count_if(F.length(F.col(c)) > n).alias(c) for c, n in cols.items()]
        wide = tables[table].agg(*aggs)
        stack = ", ".join(f"'{c}', {n}, `{c}`" for c, n in cols.items())
        frames.append(wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, max_length, too_long)")
                      .select(F.lit(table).alias("table_name"), "column_name",
                              F.col("max_length").cast("int").alias("max_length"), "too_long"))
    return _union(frames)


def rejected_feature_rows(transactions: DataFrame) -> DataFrame:
    """Transactions that cannot enter a customer sequence, with the reason."""
    return transactions.filter(F.col("customer_id").isNull()).select(
        "transaction_id", "account_id", "transaction_timestamp", "amount", F.lit("no customer").alias("reject_reason"))
