"""Per-transaction features: hand-made edge rows and a brute-force check.

The brute force follows the definition directly: sort each customer's rows
by (time, id), take the previous time, whole-customer mean and sample std,
first occurrence of the category.  The Spark plan must agree for any bucket
width and any number of shuffle partitions.
"""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyrisk.plans.gold import fraud_features
from oracle.registry import AS_OF

T0 = dt.datetime(2024, 1, 1, 0, 0)
TXN_SCHEMA = ("transaction_id int, customer_id int, account_id int, transaction_timestamp timestamp_ntz, "
              "amount decimal(12,2), amount_abs decimal(12,2), merchant_category string, is_fraud boolean, "
              "customer_age int, customer_risk_score int, account_balance decimal(12,2), transaction_hour int, "
              "is_weekend boolean, is_night boolean")


def txns(spark, rows):
    """rows: (id, customer, ts, amount, category[, risk])"""
    data = []
    for r in rows:
        i, c, ts, amt, cat = r[:5]
        risk = r[5] if len(r) > 5 else 2
        data.append((i, c, c * 10, ts, amt, abs(amt), cat, False, 40, risk, 100, ts.hour, ts.weekday() >= 5,
                     ts.hour < 6 or ts.hour > 22))
    df = spark.createDataFrame(pd.DataFrame(data, columns=[f.split()[0] for f in TXN_SCHEMA.split(", ")]))
    return df.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in TXN_SCHEMA.split(", ")])


def accounts(spark, customers):
    return spark.createDataFrame([(c * 10, 365) for c in customers], "account_id int, account_age_days int")


def feats(spark, rows, bucket_hours=24):
    t = txns(spark, rows)
    custs = sorted({r[1] for r in rows})
    return {r.transaction_id: r for r in fraud_features(t, accounts(spark, custs), AS_OF, bucket_hours=bucket_hours).collect()}


def test_single_transaction_customer(spark):
    f = feats(spark, [(1, 7, T0, 12.5, "A")])[1]
    assert float(f.amount_z_score) == 0.0
    assert f.days_since_last_transaction == 1
    assert float(f.time_since_avg) == 1.0
    assert f.is_new_merchant_for_customer is True


def test_constant_amounts_have_zero_z(spark):
    rows = [(i, 1, T0 + dt.timedelta(hours=i), 10.0, "A") for i in range(3)]
    assert all(float(r.amount_z_score) == 0.0 for r in feats(spark, rows).values())


def test_ties_ordered_by_id_and_categories(spark):
    rows = [(5, 1, T0, 1.0, "A"), (3, 1, T0, 2.0, None), (9, 1, T0 + dt.timedelta(hours=60), 3.0, "A"),
            (11, 1, T0 + dt.timedelta(hours=61), 4.0, None)]
    f = feats(spark, rows)
    # same time: id 3 comes first, id 5 follows it with a zero gap
    assert f[3].days_since_last_transaction == 1 and f[5].days_since_last_transaction == 0
    # A, NULL, A, NULL in time order -> new, new, old, old
    assert [f[i].is_new_merchant_for_customer for i in (5, 3, 9, 11)] == [True, True, False, False]
    # a 60 hour gap is 2.5 days, stored as 3
    assert f[9].days_since_last_transaction == 3


def brute_force(rows):
    df = pd.DataFrame(rows, columns=["id", "c", "ts", "amt", "cat"])
    df["x"] = df["amt"].abs()
    df = df.sort_values(["c", "ts", "id"])
    g = df.groupby("c")
    df["mean"] = g["x"].transform("mean")
    df["std"] = g["x"].transform("std")
    df["z"] = np.where(df["std"] > 0, (df["x"] - df["mean"]) / df["std"], 0.0)
    df["prev"] = g["ts"].shift(1)
    df["hours"] = ((df["ts"] - df["prev"]).dt.total_seconds() / 3600).fillna(24.0)
    df["tsa"] = df["hours"] / df.groupby("c")["hours"].transform("mean")
    df["new"] = ~df.assign(k=df["cat"].fillna("\0")).duplicated(["c", "k"])
    df["days"] = np.floor(df["hours"] / 24 + 0.5).astype(int)
    return df.set_index("id")


def random_rows(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        c = 0 if rnd.random() < 0.35 else rnd.randint(1, 12)     # one hot customer
        ts = T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        if rnd.random() < 0.05 and rows:
            ts = rows[-1][2]                                      # exact time ties
        rows.append((i, c, ts, round(rnd.uniform(-300, 300), 2), rnd.choice(["A", "B", "C", None])))
    return rows


@pytest.mark.parametrize("bucket_hours", [1, 24, 24 * 365])
def test_matches_brute_force(spark, bucket_hours):
    rows = random_rows(7)
    bf = brute_force(rows)
    got = feats(spark, rows, bucket_hours)
    for i, r in got.items():
        e = bf.loc[i]
        assert float(r.amount_z_score) == pytest.approx(round(e["z"], 4), abs=1e-4)
        assert float(r.time_since_avg) == pytest.approx(round(e["tsa"], 2), abs=1e-2)
        assert r.is_new_merchant_for_customer == bool(e["new"])
        assert r.days_since_last_transaction == int(e["days"])
        assert float(r.customer_avg_daily_spend) == pytest.approx(round(e["mean"] / 30, 2), abs=1e-2)


def test_partition_count_invariance(spark):
    rows = random_rows(11, 300)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    one = feats(spark, rows)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    eight = feats(spark, rows)
    cols = ["amount_z_score", "time_since_avg", "is_new_merchant_for_customer", "days_since_last_transaction",
            "merchant_risk_score", "distance_from_home_km"]
    for i in one:
        assert [one[i][c] for c in cols] == [eight[i][c] for c in cols]


def test_placeholder_ranges(spark):
    got = feats(spark, random_rows(3, 200))
    for r in got.values():
        assert 1 <= r.merchant_risk_score <= 9
        assert 0 <= float(r.distance_from_home_km) <= 100
        assert 0 <= float(r.velocity_kmh) <= 120
        assert float(r.fraud_probability) == (1.0 if r.is_fraud else 0.0)


def test_real_reserved_columns(spark, small_dir):
    from oracle import registry
    from tallyrisk.operators import velocity
    L = registry.spark_layers(spark, small_dir)
    t, a = L["silver_transactions"], L["account_basics"]
    real = fraud_features(t, a, AS_OF, parity=False).collect()
    parity = {r.transaction_id: r for r in fraud_features(t, a, AS_OF).collect()}
    vel = {r.transaction_id: r for r in velocity.velocity_features(t).collect()}
    risk = {r.merchant_category: r.merchant_risk_score for r in velocity.merchant_category_risk(t).collect()}
    assert len(real) == len(parity)
    for r in real:
        v = vel[r.transaction_id]
        assert (r.transaction_count_24h, r.unique_merchants_24h, r.is_new_device, r.account_transaction_count_7d) == \
               (v.transaction_count_24h, v.unique_merchants_24h, v.is_new_device, v.account_transaction_count_7d)
        assert r.merchant_risk_score == risk[r.merchant_category]
        assert r.amount_z_score == parity[r.transaction_id].amount_z_score
