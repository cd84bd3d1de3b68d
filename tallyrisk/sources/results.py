"""Results of SQL over published tables, kept for a while and shared by all readers.

A result is kept under a digest of the statement (white space outside quotes
and comments put aside), its parameters and the version of every table it may
read.  A new version of a table therefore misses at once, an unchanged one
serves the kept rows until they are older than the age limit.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.sources import files
from tallyrisk.sources.store import LayerStore

#: Quoted text and names (kept as they are), and what counts as one space outside of them.
_PARTS = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`)|(?:--[^\n]*|/\*.*?\*/|\s)+""", re.DOTALL)
ROW = "_kept_row"


def normalised(sql: str) -> str:
    """The statement without what does not change its meaning."""
    return _PARTS.sub(lambda m: m.group(1) or " ", sql).strip().rstrip(";").rstrip()


class ResultCache:
    """Results of SQL over the store's tables, in ``<root>/_results``, for ``max_age`` seconds each."""

    def __init__(self, store: LayerStore, max_age: float = 60.0, clock: Callable[[], float] = time.time):
        self.store, self.spark, self.max_age, self.clock = store, store.spark, max_age, clock
        self.root = f"{store.root}/_results"

    def _key(self, sql: str, args: dict, versions: dict[str, str]) -> str:
        said = json.dumps([normalised(sql), sorted(args.items()), sorted(versions.items())], default=repr)
        return hashlib.sha256(said.encode()).hexdigest()

    def _kept(self, key: str) -> DataFrame | None:
        """The newest result under the key, if it is young enough.  No job runs for it: its schema is kept beside it."""
        for name in sorted(files.names(self.spark, f"{self.root}/{key}"), reverse=True):
            text = files.read_text(self.spark, f"{self.root}/{key}/{name}/_facts.json")
            if text is None:
                continue  # not complete
            facts = json.loads(text)
            if self.clock() - facts["at"] > self.max_age:
                return None
            schema = T.StructType.fromJson(facts["schema"])
            rows = self.spark.read.schema(schema.add(ROW, T.LongType())).parquet(f"{self.root}/{key}/{name}/rows")
            return rows.orderBy(ROW).drop(ROW)
        return None

    def query(self, sql: str, tables: list[str], args: dict | None = None) -> DataFrame:
        """The result of ``sql``, rows in its order.

        ``sql`` names the store's tables as ``{table}`` (all are read as of one
        run) and parameters as ``:name``.
        """
        args = args or {}
        named = self.store.manifest()[1]["tables"]
        found = {t: named[t]["version"] if t in named else self.store.latest(t) for t in tables}
        key = self._key(sql, args, found)
        kept = self._kept(key)
        if kept is not None:
            return kept
        df = self.spark.sql(sql, args=args or None, **{t: self.store.read_version(t, v) for t, v in found.items()})
        path = f"{self.root}/{key}/{int(self.clock() * 1000):015}-{uuid.uuid4().hex}"
        df.withColumn(ROW, F.monotonically_increasing_id()).write.parquet(f"{path}/rows")
        files.write_text(self.spark, f"{path}/_facts.json", json.dumps({"at": self.clock(), "schema": df.schema.jsonValue()}))
        return self._kept(key)

    def purge(self) -> int:
        """Remove results older than twice the age limit (readers of younger ones may still be at it)."""
        removed = 0
        for key in files.names(self.spark, self.root):
            for name in files.names(self.spark, f"{self.root}/{key}"):
                if self.clock() - int(name.split("-")[0]) / 1000 > 2 * self.max_age:
                    files.delete(self.spark, f"{self.root}/{key}/{name}")
                    removed += 1
        return removed
