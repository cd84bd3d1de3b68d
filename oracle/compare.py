"""Shared output spec for a query: names and comparison kinds of its columns.

Kinds: ``i`` integer (compared as BIGINT), ``n`` number (DOUBLE rounded to 4
places; ``n2``, ``n8``: to that many), ``m`` money (exact decimal of two
places, compared as text), ``s`` text, ``b`` boolean, ``d`` date, ``t`` timestamp.  The same
spec projects the Spark result and the DuckDB result, so both have the same
column names, order and types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse(spec: str) -> list[tuple[str, str]]:
    out = []
    for item in spec.split():
        name, kind = item.rsplit(":", 1)
        out.append((name, kind))
    return out


def spark_project(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for name, kind in parse(spec):
        c = F.col(name)
        if kind == "i":
            c = c.cast("bigint")
        elif kind == "m":
            c = c.cast("decimal(38,2)").cast("string")
        elif kind[0] == "n":
            c = F.round(c.cast("double"), int(kind[1:] or 4))
        cols.append(c.alias(name))
    return df.select(*cols)


def sql_project(spec: str, src: str = "q") -> str:
    cols = []
    for name, kind in parse(spec):
        c = f"{src}.{name}"
        if kind == "i":
            c = f"CAST({c} AS BIGINT)"
        elif kind == "m":
            c = f"CAST(CAST({c} AS DECIMAL(38,2)) AS VARCHAR)"
        elif kind[0] == "n":
            c = f"round(CAST({c} AS DOUBLE), {int(kind[1:] or 4)})"
        cols.append(f"{c} AS {name}")
    return ", ".join(cols)
