"""Run registered queries in Spark and their SQL in DuckDB; compare results.

usage: python tools/check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from oracle import registry  # noqa: E402
from tallyrisk.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    return v


def key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in registry.REGISTRY:
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        df = registry.run_spark(name, spark, sf_dir)
        srows = [tuple(norm(x) for x in r) for r in df.collect()]
        ts = time.time() - t0
        sql = registry.oracle_text(name)
        if sql is None:
            print(f"{name:45s} spark={len(srows):6d} rows  (no oracle)  {ts:.1f}s")
            continue
        res = con.execute(sql)
        ocols = [d[0] for d in res.description]
        orows = [tuple(norm(x) for x in r) for r in res.fetchall()]
        status = "OK"
        if ocols != df.columns:
            status = f"COLS {df.columns} != {ocols}"
        elif len(orows) != len(srows):
            status = f"ROWS {len(srows)} != {len(orows)}"
        else:
            a, b = sorted(srows, key=key), sorted(orows, key=key)
            diffs = [(x, y) for x, y in zip(a, b) if x != y]
            if diffs:
                status = f"VALUES {len(diffs)} rows differ"
                for x, y in diffs[:3]:
                    cols = [(df.columns[i], x[i], y[i]) for i in range(len(x)) if x[i] != y[i]]
                    status += f"\n      {cols[:6]}"
        if status != "OK":
            bad += 1
        print(f"{name:45s} rows={len(srows):6d} {status}  {ts:.1f}s")
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
