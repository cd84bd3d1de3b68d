"""Rolling distinct counts by sweep vs a direct brute force."""

import datetime as dt
import random

import pytest

from tallyrisk.operators.velocity import distinct_in_range

T0 = dt.datetime(2024, 1, 1, 0, 0)


def brute(rows, width):
    out = {}
    for i, c, t, m in rows:
        window = {m2 for _, c2, t2, m2 in rows if c2 == c and m2 is not None and t - width <= t2 <= t}
        out[i] = len(window)
    return out


@pytest.mark.parametrize("rows_per_bucket", [None, 7])
def test_distinct_in_range_matches_brute_force(spark, rows_per_bucket):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        c = 0 if i % 3 == 0 else rnd.randint(1, 5)
        t = T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 6))
        if rows and rnd.random() < 0.1:
            t = rows[-1][2]                                   # time ties
        if rows and rnd.random() < 0.1:
            t = rows[-1][2] + dt.timedelta(hours=24)          # exactly one frame later
        rows.append((i, c, t, rnd.choice(["a", "b", "c", "d", None])))
    df = spark.createDataFrame(rows, "id int, c int, t timestamp_ntz, m string")
    got = {r.id: r.distinct_m
           for r in distinct_in_range(df, "c", "t", "m", "id", 24, rows_per_bucket=rows_per_bucket).collect()}
    assert got == brute(rows, dt.timedelta(hours=24))


@pytest.mark.parametrize("rows_per_bucket", [None, 7])
def test_rolling_sweep_matches_brute_force(spark, rows_per_bucket):
    from pyspark.sql import functions as F

    from tallyrisk.operators.velocity import rolling
    rnd = random.Random(9)
    rows = []
    for i in range(500):
        c = 0 if i % 2 == 0 else rnd.randint(1, 4)
        t = T0 + dt.timedelta(seconds=rnd.randint(0, 3600 * 24 * 4))
        if rows and rnd.random() < 0.1:
            t = rows[-1][2]
        if rows and rnd.random() < 0.1:
            t = rows[-1][2] + dt.timedelta(hours=1)           # exactly on the 1 h frame edge
        rows.append((i, c, t, round(rnd.uniform(0, 100), 2)))
    df = spark.createDataFrame(rows, "id int, c int, t timestamp_ntz, v double").withColumn(
        "v", F.col("v").cast("decimal(12,2)"))
    got = {r.id: r for r in rolling(df, "c", "t", "id", {"n1": (1, None), "n24": (24, None),
                                                         "s24": (24, F.col("v"))},
                                    rows_per_bucket=rows_per_bucket).collect()}
    for i, c, t, v in rows:
        w1 = [x for x in rows if x[1] == c and t - dt.timedelta(hours=1) <= x[2] <= t]
        w24 = [x for x in rows if x[1] == c and t - dt.timedelta(hours=24) <= x[2] <= t]
        assert got[i].n1 == len(w1) and got[i].n24 == len(w24)
        assert float(got[i].s24) == round(sum(x[3] for x in w24), 2)
