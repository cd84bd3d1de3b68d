"""Layer table store on shared storage (Parquet), published run by run.

    <root>/<table>/v=<version>/   a complete version of a table, marked _PUBLISHED
    <root>/_runs/<n>.json         which version of every table readers see after the n-th run

A10: a run writes new versions beside the old ones and then one manifest, which
names a version of every table.  Readers resolve all tables through the newest
manifest, so they see all of a run or nothing of it; a run that dies leaves the
tables as they were, together.  An empty result is not published (the previous
version stays), like the source system's guard.
A06/A07/A11/A12: scans, SQL over registered views, JDBC and CSV.
"""

from __future__ import annotations

import contextlib
import json
import logging
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyrisk.sources import files

log = logging.getLogger(__name__)

PUBLISHED = "_PUBLISHED"
BUCKETS = "_BUCKETS"


def _order(version: str) -> list[tuple[int, int, str]]:
    """Numbers in a version name compare as numbers: v9 before v10."""
    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"([0-9]+)", version) if x]


class Published(int):
    """Rows of a published version (0: none, so not published); ``facts`` has what was observed while writing."""

    facts: dict[str, object]

    def __new__(cls, facts: dict[str, object]):
        out = super().__new__(cls, facts["rows"])
        out.facts = facts
        return out


class ConcurrentRunError(RuntimeError):
    pass


class Run:
    """The tables of a run in progress: its own versions, and else those that stood when it began."""

    def __init__(self, store: LayerStore, version: str):
        self.store, self.version = store, version
        self.number, base = store.manifest()
        self.base = base["tables"]
        self.tables: dict[str, dict] = {}
        self.read_tables: set[str] = set()
        self.sources: dict[str, object] = {}

    def version_of(self, table: str) -> str | None:
        if table in self.tables:
            return self.tables[table]["version"]
        self.read_tables.add(table)
        return self.base[table]["version"] if table in self.base else None

    def read(self, table: str) -> DataFrame:
        return self.store.read_version(table, self.version_of(table))

    def bucketing(self, table: str) -> tuple[int, list[str]] | None:
        return self.store.bucketing(table, self.version_of(table))

    def publish(self, table: str, df: DataFrame, **layout) -> Published:
        done = self.store.write_version(table, df, self.version, **layout)
        if done:
            self.tables[table] = {"version": self.version, "facts": done.facts}
        return done

    def facts(self, table: str) -> dict[str, object]:
        """What was observed when the table's version was written."""
        found = self.tables.get(table) or self.base.get(table)
        return found["facts"] if found else {}

    def commit(self) -> None:
        """Swap the manifest in.  Another run's manifest in between is kept, unless it changed tables of this run."""
        while True:
            number, now = self.store.manifest()
            changed = {t for t, v in now["tables"].items() if self.base.get(t) != v}
            if number != self.number and changed & (self.read_tables | set(self.tables)):
                raise ConcurrentRunError(f"another run published {sorted(changed)} in the meantime; nothing published")
            merged = {"run": self.version, "tables": now["tables"] | self.tables, "sources": now["sources"] | self.sources}
            if self.store.commit(number, merged):
                return


class LayerStore:
    """``keep``: manifests whose versions stay after a new one (0: all)."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 0):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep

    # --- manifests ----------------------------------------------------------

    def _manifest_path(self, number: int) -> str:
        return f"{self.root}/_runs/{number:012}.json"

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names(self.spark, f"{self.root}/_runs") if n.endswith(".json"))

    def manifest(self, number: int | None = None) -> tuple[int, dict]:
        """(number, manifest) of the newest run, or of that one; 0 and no tables before the first."""
        numbers = self._numbers()
        number = number or (numbers[-1] if numbers else 0)
        text = files.read_text(self.spark, self._manifest_path(number)) if number else None
        return number, json.loads(text) if text else {"run": None, "tables": {}, "sources": {}}

    def commit(self, after: int, manifest: dict) -> bool:
        """Write the manifest that follows number ``after``; False if there is one already."""
        if not files.create_once(self.spark, self._manifest_path(after + 1), json.dumps(manifest, default=str)):
            return False
        if self.keep:
            self._expire()
        return True

    def _expire(self) -> None:
        """Remove the manifests beyond the ``keep`` newest, and the versions that only they name."""
        numbers = self._numbers()
        held = [self.manifest(n)[1]["tables"] for n in numbers]
        kept = {(t, v["version"]) for tables in held[-self.keep:] for t, v in tables.items()}
        for number, tables in zip(numbers[:-self.keep], held, strict=False):
            for table, v in tables.items():
                if (table, v["version"]) not in kept:
                    files.delete(self.spark, f"{self.path(table, v['version'])}/{PUBLISHED}")
                    files.delete(self.spark, self.path(table, v["version"]))
            files.delete(self.spark, self._manifest_path(number))

    @contextlib.contextmanager
    def run(self, version: str) -> Iterator[Run]:
        """Publish several tables as one: the manifest is swapped in at the end, or not at all."""
        if not self._numbers():
            self.commit(0, {"run": None, "tables": self._adopted(), "sources": {}})
        run = Run(self, version)
        yield run
        run.commit()

    def _adopted(self) -> dict[str, dict]:
        """The tables of a store from before its first manifest."""
        names = [n for n in files.names(self.spark, self.root) if not n.startswith(("_", "."))]
        found = {n: self.marked(n) for n in names}
        return {n: {"version": v, "facts": {}} for n, v in found.items() if v}

    # --- tables -------------------------------------------------------------

    def path(self, table: str, version: str) -> str:
        return f"{self.root}/{table}/v={version}"

    def marked(self, table: str) -> str | None:
        """The newest complete version by its name (of a store without manifests)."""
        names = [n[2:] for n in files.names(self.spark, f"{self.root}/{table}") if n.startswith("v=")]
        done = [v for v in names if PUBLISHED in files.names(self.spark, self.path(table, v))]
        return max(done, key=_order, default=None)

    def latest(self, table: str) -> str | None:
        """The version that readers see."""
        number, manifest = self.manifest()
        if table in manifest["tables"]:
            return manifest["tables"][table]["version"]
        return None if number else self.marked(table)

    def read(self, table: str) -> DataFrame:
        """Scan the version that the newest run published."""
        return self.read_version(table, self.latest(table))

    def snapshot(self, tables: list[str], number: int | None = None) -> dict[str, DataFrame]:
        """Several tables of one run."""
        found = self.manifest(number)[1]["tables"]
        return {t: self.read_version(t, found[t]["version"] if t in found else None) for t in tables}

    def read_version(self, table: str, version: str | None) -> DataFrame:
        """One version of a table.

        A bucketed version is registered as a bucketed catalog table first,
        so joins and windows on its bucket columns need no shuffle.
        """
        if version is None:
            raise FileNotFoundError(f"no published version of {table} under {self.root}")
        path = self.path(table, version)
        spec = self.bucketing(table, version)
        if spec is None:
            return self.spark.read.parquet(path)
        n, cols = spec
        name = f"{table}__v{version}"
        if not self.spark.catalog.tableExists(name):
            schema = self.spark.read.parquet(path).schema
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet "
                           f"CLUSTERED BY ({', '.join(cols)}) INTO {n} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def bucketing(self, table: str, version: str | None = None) -> tuple[int, list[str]] | None:
        """(bucket count, bucket columns) of a version (the one readers see), if bucketed."""
        version = version or self.latest(table)
        text = files.read_text(self.spark, f"{self.path(table, version)}/{BUCKETS}") if version else None
        if not text:
            return None
        n, cols = text.split(":", 1)
        return int(n), cols.split(",")

    def facts(self, table: str) -> dict[str, object]:
        """Rows and other facts observed when the table's version was written."""
        found = self.manifest()[1]["tables"].get(table)
        return found["facts"] if found else {}

    def publish(self, table: str, df: DataFrame, version: str, **layout) -> Published:
        """A10: a run of one table (:meth:`write_version` has the layout)."""
        with self.run(version) as run:
            return run.publish(table, df, **layout)

    def write_version(self, table: str, df: DataFrame, version: str, partition_by: list[str] | None = None,
                      sort_within: list[str] | None = None, bucket_by: tuple[int, list[str]] | None = None,
                      observe: dict[str, Column] | None = None, hidden: tuple[str, ...] = ()) -> Published:
        """Write a full new version and mark it complete; no reader sees it before a manifest names it.

        The plan runs once.  Rows, and the aggregates in ``observe``, are
        counted by the writing tasks; ``hidden`` columns are for these alone.
        A version that came out empty is left unmarked, and so is one whose job
        died; it may be written again.  ``partition_by``: rows are gathered by
        these columns first (a rebalance: a large value is cut into several
        files, small ones share tasks), so a value has few files and not one
        from every task.
        """
        path = self.path(table, version)
        if PUBLISHED in files.names(self.spark, path) and any(
                self.manifest(n)[1]["tables"].get(table, {}).get("version") == version for n in self._numbers()):
            raise ValueError(f"{table}: version {version} is published already")
        if bucket_by:
            df = df.repartition(bucket_by[0], *bucket_by[1])
        elif partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        if sort_within and not bucket_by:
            # Local sort inside each write task (no shuffle): tight Parquet
            # row-group min/max on these columns, so range filters skip data.
            df = df.sortWithinPartitions(*sort_within)
        seen = Observation()
        wanted = {"rows": F.count(F.lit(1))} | (observe or {})
        df = df.observe(seen, *[c.alias(n) for n, c in wanted.items()]).drop(*hidden)
        w = df.write.mode("overwrite")
        if bucket_by:
            n, cols = bucket_by
            w = w.format("parquet").bucketBy(n, *cols).option("path", path)
            if sort_within:
                w = w.sortBy(*sort_within)
            w.saveAsTable(f"{table}__v{version}")
        else:
            (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        facts = {n: seen.get[n] for n in wanted}
        if not facts["rows"]:
            log.warning("no rows for %s; previous version kept", table)
            return Published(facts)
        if bucket_by:
            files.write_text(self.spark, f"{path}/{BUCKETS}", f"{n}:{','.join(cols)}")
        files.write_text(self.spark, f"{path}/{PUBLISHED}", "")
        return Published(facts)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql_scan(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """SQL over registered views, with optional named parameters (``:name``)."""
    return spark.sql(text, args=args) if args else spark.sql(text)


@contextlib.contextmanager
def cached(df: DataFrame):
    """Keep a result in memory (spilling to disk) for repeated reads; :mod:`results` keeps results of SQL."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV output (one folder of part files), lossless for text
    (no whitespace trimming) and for timestamps (microseconds kept)."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .csv(path))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str, lower: int, upper: int, num_partitions: int) -> DataFrame:
    """Optional relational store, read as ``num_partitions`` parallel range scans of a numeric column."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "append") -> None:
    df.write.jdbc(url, table, mode=mode, properties=properties)
