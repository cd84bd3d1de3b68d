"""Physical plan properties that matter at scale (checked on the explain text)."""

import re

from oracle import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + \
        df._jdf.queryExecution().optimizedPlan().toString()


def test_feature_rows_hashed_on_customer_and_bucket(spark, small_dir):
    df = registry.REGISTRY["H06_gold_fraud_features"].build(registry.spark_layers(spark, small_dir))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(customer_id#\d+L?, _bucket#\d+", plan)
    # the row-level window is partitioned by (customer, bucket), never by customer alone
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", plan):
        assert "_bucket" in m.group(1) or "transaction_id" not in plan[m.start():m.start() + 400]


def test_no_cartesian_products(spark, small_dir):
    L = registry.spark_layers(spark, small_dir)
    for name in ("H06_gold_fraud_features", "H09_customer_risk_dashboard", "D21_global_stats",
                 "E08_E15_velocity_real", "Q06_foreign_key_orphans"):
        plan = registry.REGISTRY[name].build(L)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_date_range_reaches_the_scan(spark, small_dir):
    df = registry.run_spark("D10_kpi_cards", spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(ts,", plan)


def _scans(df) -> list[str]:
    return re.findall(r"Relation \[([a-z_]+)", df._jdf.queryExecution().optimizedPlan().toString())


def test_feature_plan_reads_events_twice(spark, small_dir):
    """The rows and one summary; the summary joins no dimension."""
    df = registry.REGISTRY["H06_gold_fraud_features"].build(registry.spark_layers(spark, small_dir))
    scans = _scans(df)
    assert scans.count("event_id") == 2
    assert scans.count("c_custkey") == 3  # customers and accounts for the context, accounts for their age
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1  # the rows' one full-width shuffle before the windows


def test_reports_that_need_no_sequence_repartition_nothing(spark, small_dir):
    for name in ("D10_kpi_cards", "D11_fraud_by_hour", "D12_risky_merchant_categories", "Q11_sample_fraud_features",
                 "H08_current_fraud_alerts", "Q03_gold_row_counts"):
        df = registry.REGISTRY[name].build(registry.spark_layers(spark, small_dir))
        assert "REPARTITION_BY_COL" not in df._jdf.queryExecution().executedPlan().toString(), name
        if name.startswith("D1"):
            assert _scans(df).count("event_id") == 1, name
    alerts = registry.REGISTRY["G05_recent_fraud_alerts"].build(registry.spark_layers(spark, small_dir))
    assert "REPARTITION_BY_COL" not in alerts._jdf.queryExecution().executedPlan().toString()


def test_velocity_reads_events_six_times_and_joins_no_row_id(spark, small_dir):
    df = registry.REGISTRY["E08_E15_velocity_real"].build(registry.spark_layers(spark, small_dir))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") <= 6
    # Two full-width exchanges, the customers' stream and the accounts'; rows meet nothing by a join.
    assert plan.count("REPARTITION_BY_COL") == 2
    assert not re.search(r"Join \[[^\]]*transaction_id", plan)


def test_foreign_key_check_reads_each_child_once(spark, small_dir):
    df = registry.REGISTRY["Q06_foreign_key_orphans"].build(registry.spark_layers(spark, small_dir))
    assert len(_scans(df)) <= 16
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count(1)") >= 6  # children are counted by key before they are joined


def test_sizing_for_100_tb():
    from tallyrisk.session import sizing_conf
    conf = sizing_conf(100 * 1024 ** 4, executor_cores=4, executors=1000)
    # about 27,000 partitions of 1.5 GB, not hundreds of thousands
    assert 20_000 < int(conf["spark.sql.shuffle.partitions"]) < 40_000
    small = sizing_conf(10 * 1024 ** 2, executor_cores=4, executors=2)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_broadcast_only_under_the_session_bound(spark):
    from tallyrisk.operators.joins import join_dimension
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).withColumnRenamed("id", "k")
    from tallyrisk.operators.joins import estimated_bytes
    assert estimated_bytes(dim) == 80
    plan = join_dimension(fact, dim, "k", max_broadcast_bytes=1)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()
    plan = join_dimension(fact, dim, "k", max_broadcast_bytes=10 ** 9)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan.lower()


def test_set_operations_over_lazy_silver(spark, small_dir):
    """EXCEPT ALL / INTERSECT ALL over the lazily joined silver table work."""
    st = registry.spark_layers(spark, small_dir)["silver_transactions"]
    assert st.exceptAll(st).count() == 0
    assert st.intersectAll(st).count() == st.count()
