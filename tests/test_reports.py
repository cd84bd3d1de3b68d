"""Reports and layer tables on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oracle.registry import AS_OF
from tallyrisk.plans import gold, reports

T = dt.datetime(2024, 2, 1, 12)


def test_dashboard_fan_out_compat_and_corrected(spark):
    c360 = spark.createDataFrame(
        [(1, "A B", "S", 10.0, 2, "1-3 years", 0.1), (2, "C D", "S", 5.0, 1, None, 0.0),
         (3, "E F", "S", 0.0, 3, None, 0.0)],
        "customer_id int, full_name string, demographic_segment string, total_relationship_balance double, "
        "overall_risk_score int, risk_tier string, fraud_probability double")
    accts = spark.createDataFrame([(10, 1), (11, 1), (20, 2)], "account_id int, customer_id int")
    txns = spark.createDataFrame(
        [(1, T, True), (1, T, True), (1, T, True), (1, T, False), (3, T, True),
         (2, T - dt.timedelta(days=200), True)],
        "customer_id int, transaction_timestamp timestamp_ntz, is_fraud boolean")
    compat = {r.customer_id: r for r in reports.customer_risk_dashboard(c360, accts, txns, AS_OF, compat=True).collect()}
    fixed = {r.customer_id: r for r in reports.customer_risk_dashboard(c360, accts, txns, AS_OF, compat=False).collect()}
    # 2 accounts x 3 frauds: the source view counts 6; the true number is 3
    assert compat[1].fraud_count_90d == 6 and fixed[1].fraud_count_90d == 3
    assert compat[1].account_count == 2
    # a customer without accounts still counts each fraud once
    assert compat[3].fraud_count_90d == 1 and compat[3].account_count == 0
    # old transactions are outside the 90-day condition of the join
    assert compat[2].fraud_count_90d == 0 and compat[2].last_transaction_date is None


def test_daily_without_fraud(spark):
    t = spark.createDataFrame(
        [(T, 1, 10.0, False), (T, 2, 5.0, False), (T + dt.timedelta(days=1), 1, 4.0, True)],
        "transaction_timestamp timestamp_ntz, customer_id int, amount_abs double, is_fraud boolean")
    t = t.withColumn("amount_abs", F.col("amount_abs").cast("decimal(12,2)"))
    rows = {r.summary_date: r for r in gold.daily_fraud_summary(t, AS_OF).collect()}
    d0, d1 = rows[T.date()], rows[(T + dt.timedelta(days=1)).date()]
    assert float(d0.fraud_rate) == 0.0 and d0.avg_fraud_amount is None and d0.affected_customers == 2
    assert float(d1.fraud_rate) == 1.0 and float(d1.avg_fraud_amount) == 4.0
    assert d1.auto_detected_count == 0 and d0.fraud_by_channel == "{}"


def test_layer_invariants(spark, small_dir):
    from tallyrisk.plans.layers import all_layers
    from tallyrisk.sources.fixtures import bronze_frames
    L = all_layers(bronze_frames(spark, small_dir), AS_OF)
    n_txn = L["bronze_transactions"].count()
    assert L["silver_transactions"].count() == n_txn
    with_customer = L["bronze_transactions"].filter("customer_id IS NOT NULL").count()
    assert 0 < with_customer < n_txn and L["gold_fraud_features"].count() == with_customer
    assert L.features("transaction_id").count() == with_customer
    assert L["silver_customers"].count() == L["bronze_customers"].count()
    total = L["gold_daily_fraud_summary"].agg(F.sum("total_transactions")).first()[0]
    assert total == n_txn
    # customers who always pay the same amount, over many days
    constant = L["gold_fraud_features"].filter(F.col("customer_id") % 53 == 0)
    assert constant.select("transaction_timestamp").distinct().count() > 1
    assert constant.filter("amount_z_score <> 0").count() == 0
    # per-customer mean of z is 0
    worst = (L["gold_fraud_features"].groupBy("customer_id")
             .agg(F.abs(F.avg(F.col("amount_z_score").cast("double"))).alias("m"))
             .agg(F.max("m")).first()[0])
    assert worst < 1e-3


def test_dashboard_pack_matches_registered_queries(spark, small_dir):
    from oracle import registry
    L = registry.spark_layers(spark, small_dir)
    pack = reports.dashboard_pack(L["gold_fraud_features"], L["gold_daily_fraud_summary"], AS_OF)
    assert set(pack) == {"kpi_cards", "fraud_by_hour", "risky_merchant_categories", "daily_trend",
                         "recent_fraud_alerts"}
    assert pack["kpi_cards"].first().total_txns > 0
    assert pack["recent_fraud_alerts"].count() <= 20
    with __import__("tallyrisk.sources.store", fromlist=["cached"]).cached(pack["fraud_by_hour"]) as hourly:
        assert hourly.count() == hourly.count() <= 24


def test_sql_over_registered_views(spark, small_dir):
    """SQL text over registered views, with named parameters."""
    import datetime as _dt

    from oracle import registry
    from tallyrisk.sources.store import register_views, sql_scan
    L = registry.spark_layers(spark, small_dir)
    register_views(spark, {"features_view": L["gold_fraud_features"]})
    n = sql_scan(spark, "SELECT count(*) AS n FROM features_view WHERE to_date(transaction_timestamp) "
                        "BETWEEN :start AND :end", {"start": _dt.date(2024, 1, 1), "end": _dt.date(2024, 1, 10)}).first().n
    direct = L["gold_fraud_features"].filter(F.to_date("transaction_timestamp") <= "2024-01-10").count()
    assert n == direct > 0


ORDERED = {  # the order each report promises
    "H08_current_fraud_alerts": "fraud_probability DESC, transaction_id",
    "B19_daily_trend": "summary_date",
    "D11_fraud_by_hour": "transaction_hour",
    "D14_segment_by_risk": "segment NULLS LAST, risk_score NULLS LAST",
    "D15_account_type_distribution": "account_count DESC, account_type",
    "D17_fraud_by_hour_group": "list_position(['Late Night', 'Morning', 'Afternoon', 'Evening', 'Night'], hour_group)",
    "G05_recent_fraud_alerts": "transaction_timestamp DESC, transaction_id DESC",
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_reports_come_in_their_order(spark, small_dir, name):
    import duckdb

    from oracle import registry
    c = duckdb.connect()
    for t in ("customer", "nation", "orders", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    expected = c.execute(f"SELECT * FROM ({registry.oracle_text(name)}) o ORDER BY {ORDERED[name]}").fetchall()
    got = [tuple(r) for r in registry.run_spark(name, spark, small_dir).collect()]
    first = [str(r[0]) for r in expected]
    assert len(expected) > 1 and [str(r[0]) for r in got] == first


def test_recent_alerts_over_stored_and_lazy_features_are_the_same(spark, small_dir):
    from oracle import registry
    L = registry.spark_layers(spark, small_dir)
    stored = reports.recent_fraud_alerts(L["gold_fraud_features"]).collect()
    lazy = reports.recent_fraud_alerts_lazy(L.features(*reports.ALERT_FEATURES), L["transaction_basics"]).collect()
    assert stored == lazy and 0 < len(stored) <= 20
