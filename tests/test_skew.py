"""A customer with a third of all rows must not become one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyrisk.operators.sequence import with_sequence_features


def test_hot_customer_is_spread_over_tasks(spark):
    n = 30_000
    base = spark.range(n).select(
        F.col("id").cast("int").alias("transaction_id"),
        # a third of the rows belong to customer 0, the rest to 500 others
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.col("id") % 500).cast("int").alias("customer_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 7) % (60 * 24 * 60))).alias("transaction_timestamp"),
        (F.col("id") % 1000 / 10).cast("decimal(12,2)").alias("amount_abs"),
        F.lit("A").alias("merchant_category"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # keep the 8 hash partitions visible
    try:
        out = with_sequence_features(base, bucket_hours=24)
        sizes = (out.groupBy(F.spark_partition_id().alias("p")).count()
                 .agg(F.max("count").alias("mx"), F.sum("count").alias("n")).first())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes.n == n
    # with plain per-customer partitioning one task would hold >= 1/3 of the rows
    assert sizes.mx < n / 4


DAY = dt.datetime(2024, 1, 1)


def _rows(spark, hot_time, n=30_000, extra=None):
    """A third of the rows from customer 0, with ``hot_time`` (an expression of id) as their time."""
    base = spark.range(n).select(
        F.col("id").cast("long").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.col("id") % 500).cast("int").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, hot_time).otherwise(
            F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 7) % 80_000)
        ).alias("transaction_timestamp"),
        (F.col("id") % 1000 / 10).cast("decimal(12,2)").alias("amount_abs"),
        F.concat(F.lit("m"), F.col("id") % 5).alias("merchant_category"))
    return base if extra is None else base.unionByName(extra)


def _seconds(c):
    return F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c)


def _cases(spark):
    old = spark.sql("SELECT 10000000L AS transaction_id, 0 AS customer_id, timestamp_ntz'1994-01-01 00:00:00' AS "
                    "transaction_timestamp, 1.00BD AS amount_abs, 'm1' AS merchant_category")
    burst = _seconds((F.col("id") * 7) % 80_000)
    return {
        "burst": _rows(spark, burst),
        "burst and one old row": _rows(spark, burst, extra=old),
        "one second": _rows(spark, _seconds(F.lit(5)) + F.make_dt_interval(secs=(F.col("id") % 1000 / 1000).cast("decimal(18,6)"))),
        "one instant": _rows(spark, _seconds(F.lit(5))),
        "no time": _rows(spark, F.lit(None).cast("timestamp_ntz")),
    }


@pytest.mark.parametrize("case", ["burst", "burst and one old row", "one second", "one instant", "no time"])
def test_crowded_buckets_are_split_and_results_stay(spark, case):
    from tallyrisk.operators.sequence import assign_buckets
    base, limit = _cases(spark)[case], 500
    cells = assign_buckets(base, "customer_id", "transaction_timestamp", "transaction_id", 24, limit)
    most = cells.groupBy("customer_id", "_bucket").count().agg(F.max("count")).first()[0]
    assert most <= limit
    cols = ["transaction_id", "_prev_ts", "_is_first_group", "_mean_value", "_std_value", "_mean_gap_hours"]
    fixed = {r[0]: r for r in with_sequence_features(base, bucket_hours=24).select(*cols).collect()}
    split = {r[0]: r for r in with_sequence_features(base, bucket_hours=24, rows_per_bucket=limit).select(*cols).collect()}
    assert fixed.keys() == split.keys()
    untimed = case == "no time"
    for k, r in split.items():
        f = fixed[k]
        # A row without a time has no gap to its predecessor, whichever that is.
        assert r[2] == f[2] and (untimed or r[1] == f[1]), k
        for i in (3, 4, 5):
            assert (r[i] is None and f[i] is None) or abs(r[i] - f[i]) < 1e-9


def test_no_bucket_gets_wider_than_the_default(spark):
    from tallyrisk.operators.sequence import assign_buckets
    base = _cases(spark)["burst and one old row"]
    b = assign_buckets(base, "customer_id", "transaction_timestamp", "transaction_id", 24, 500)
    days = b.groupBy("customer_id", "_bucket").agg(
        F.timestamp_diff("HOUR", F.min("transaction_timestamp"), F.max("transaction_timestamp")).alias("h"))
    assert days.agg(F.max("h")).first()[0] < 24


def test_velocity_of_a_crowded_customer(spark):
    from tallyrisk.operators.velocity import velocity_features
    base = _cases(spark)["one second"].select(
        "*", F.col("customer_id").alias("account_id"), F.col("amount_abs").alias("amount"),
        F.col("merchant_category").alias("merchant_name_clean"),
        F.concat(F.lit("d"), F.col("transaction_id")).alias("device_id"),
        F.when(F.col("transaction_id") % 2 == 0, F.lit("x")).alias("merchant_location"))
    a = {r[0]: r for r in velocity_features(base, rows_per_bucket=None).collect()}
    b = {r[0]: r for r in velocity_features(base, rows_per_bucket=500).collect()}
    assert a == b


def test_first_sightings_grow_in_proportion(spark):
    """Distinct devices of one customer-day: no list is searched row by row."""
    import time

    from tallyrisk.operators.velocity import with_first_sightings

    def took(n):
        rows = spark.range(n).select(F.lit(1).alias("c"), _seconds(F.col("id") % 80_000).alias("t"), F.col("id"),
                                     F.concat(F.lit("d"), F.col("id")).alias("d")).repartition(8)
        start = time.perf_counter()
        assert with_first_sightings(rows, "c", "t", "id", {"new": "d"}).filter("new").count() == n
        return time.perf_counter() - start

    took(1000)
    small, large = took(50_000), took(200_000)
    assert large < 8 * small + 2


def test_skewed_dimension_join_is_split(spark):
    """A key with a third of the rows, no broadcast: AQE splits its partition."""
    from tallyrisk.operators.joins import join_dimension
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(600_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"),
                                           F.xxhash64("id").alias("v")).repartition(16)
        dim = spark.range(5000).select(F.col("id").alias("k"), F.xxhash64("id").alias("w"))
        joined = join_dimension(fact, dim, "k").select("v", "w")
        assert len(joined.collect()) == 600_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_summaries_over_blocks_are_the_same_and_spread(spark):
    """A customer with very many buckets: windows over the key see a row a block; no figure changes."""
    from tallyrisk.operators.sequence import Cells, group_summary, with_cells

    base = _rows(spark, F.when(F.col("id") % 17 != 0, _seconds(F.col("id") * 1700 % 40_000_000)), n=9000)
    t = with_cells(base, "customer_id", "transaction_timestamp", "transaction_id", Cells(1))
    order = ["customer_id", "_bucket", "_group"]

    def rows(blocks):
        df = group_summary(t, "customer_id", "transaction_timestamp", "amount_abs", "merchant_category", blocks)
        return {(r["customer_id"], tuple(r["_bucket"]), r["_group"]): r.asDict() for r in df.orderBy(*order).collect()}

    plain, blocked = rows(False), rows(True)
    assert plain.keys() == blocked.keys() and len(plain) > 5000
    for k, r in plain.items():
        for c in ("_prev_bucket_last_ts", "_n_value", "_new_group"):
            assert r[c] == blocked[k][c], (k, c)
        for c in ("_mean_value", "_std_value", "_mean_gap_hours"):
            assert (r[c] is None) == (blocked[k][c] is None) and (r[c] is None or abs(r[c] - blocked[k][c]) < 1e-9), (k, c)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = group_summary(t.filter("customer_id = 0"), "customer_id", "transaction_timestamp", "amount_abs", "merchant_category", True)
        most = df.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert most[0] < most[1] / 3
