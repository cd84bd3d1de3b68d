"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(("nan" if isinstance(x, float) and math.isnan(x) else
                          round(x, 4) if isinstance(x, float) else x) for x in r))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.REGISTRY))
def test_query_matches_oracle(spark, con, small_dir, name):
    df = entry.queries()[name](spark, small_dir)
    res = con.execute(entry.oracle_sql()[name])
    assert df.columns == [d[0] for d in res.description]
    assert _norm(df.collect()) == _norm(res.fetchall())


def test_every_query_has_oracle_or_is_listed():
    missing = set(registry.REGISTRY) - set(entry.oracle_sql())
    assert missing <= registry.NO_ORACLE
    assert set(registry.REGISTRY) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "amount_z_score" in df.columns
