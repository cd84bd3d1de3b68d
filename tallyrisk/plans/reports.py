"""Reports over the gold and silver tables: alert views and dashboard queries.

All report inputs are filtered before they are joined, and every top-k has a
unique tie-breaker so the k rows are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.functions import rules
from tallyrisk.functions.temporal import instant_days_ago
from tallyrisk.operators.joins import join_dimension

# The feature columns that the reports read.
ALERT_FEATURES = ["transaction_id", "customer_id", "account_id", "transaction_timestamp", "amount", "merchant_category",
                  "fraud_risk_tier", "fraud_probability", "is_fraud"]
RATE_FEATURES = ["customer_id", "transaction_timestamp", "transaction_hour", "merchant_category", "is_fraud"]

ALERT_COLUMNS = ["transaction_id", "transaction_timestamp", "full_name", "account_number_masked",
                 "amount", "merchant_category", "fraud_risk_tier", "fraud_probability", "alert_level"]


def current_fraud_alerts(features: DataFrame, customer_360: DataFrame, accounts: DataFrame,
                         as_of, days: int = 7) -> DataFrame:
    """Frauds of the last ``days`` days with owner and masked account, highest first."""
    f = features.filter(F.col("is_fraud") & (F.col("transaction_timestamp") > instant_days_ago(as_of, days)))
    f = join_dimension(f, customer_360.select("customer_id", "full_name"), "customer_id", "inner")
    f = join_dimension(f, accounts.select("account_id", "account_number_masked"), "account_id", "inner")
    return (f.select(*ALERT_COLUMNS[:-1],
                     rules.alert_level(F.col("fraud_probability")).alias("alert_level"))
            .orderBy(F.col("fraud_probability").desc_nulls_first(), F.col("transaction_id")))


RISK_DASHBOARD_KEYS = ["customer_id", "full_name", "demographic_segment", "total_relationship_balance",
                       "overall_risk_score", "risk_tier", "fraud_probability"]


def customer_risk_dashboard(customer_360: DataFrame, accounts: DataFrame, transactions: DataFrame,
                            as_of, days: int = 90, compat: bool = True) -> DataFrame:
    """Per-customer accounts, recent frauds and last activity.

    The source view joins accounts and transactions to the customer at once,
    so each fraud is counted once per account (``compat=True`` reproduces
    that number).  Both sides are aggregated per customer *before* the join
    here, so no account x transaction pairs are ever built; the fan-out
    factor is applied arithmetically.  ``compat=False`` gives the true count.
    """
    a = accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_account_rows"),
        F.count_distinct("account_id").alias("account_count"))
    recent = transactions.filter(F.col("transaction_timestamp") > instant_days_ago(as_of, days))
    t = recent.groupBy("customer_id").agg(
        F.count_if(F.col("is_fraud")).alias("_frauds"),
        F.max("transaction_timestamp").alias("last_transaction_date"))
    c = customer_360.select(*RISK_DASHBOARD_KEYS)
    c = c.join(a, "customer_id", "left").join(t, "customer_id", "left")
    frauds = F.coalesce(F.col("_frauds"), F.lit(0))
    if compat:
        frauds = frauds * F.greatest(F.coalesce(F.col("_account_rows"), F.lit(0)), F.lit(1))
    return c.select(*RISK_DASHBOARD_KEYS,
                    F.coalesce(F.col("account_count"), F.lit(0)).alias("account_count"),
                    frauds.cast("bigint").alias("fraud_count_90d"),
                    "last_transaction_date")


def default_window(as_of, days: int = 30) -> tuple[dt.date, dt.date]:
    """The dashboard's default date range: the ``days`` days up to as_of."""
    end = dt.datetime.fromisoformat(str(as_of)).date()
    return end - dt.timedelta(days=days), end


# The measures of all rate reports.
RATE_MEASURES = {"total": "count(1)", "fraud": "count_if(is_fraud)",
                 "fraud_rate": "100 * avg(cast(coalesce(is_fraud, false) as int))"}


def kpi_cards(features: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """D10 via A08: the rate measures and the customers of a date range, the range as SQL parameters."""
    inside = features.sparkSession.sql(
        "SELECT * FROM {features} WHERE transaction_timestamp >= :start AND transaction_timestamp < :after",
        args={"start": dt.datetime.combine(start, dt.time()), "after": dt.datetime.combine(end + dt.timedelta(days=1), dt.time())},
        features=features)
    m = RATE_MEASURES
    return inside.selectExpr(f"{m['total']} AS total_txns", f"{m['fraud']} AS fraud_txns", f"{m['fraud_rate']} AS fraud_rate",
                             "count(DISTINCT customer_id) AS unique_customers")


def _rate_by(features: DataFrame, key: str) -> DataFrame:
    return features.groupBy(key).agg(*[F.expr(e).alias(n) for n, e in RATE_MEASURES.items()])


def fraud_by_hour(features: DataFrame) -> DataFrame:
    """Fraud rate (percent) per hour of day."""
    return _rate_by(features, "transaction_hour").orderBy("transaction_hour")


def risky_merchant_categories(features: DataFrame, min_count: int = 10, k: int = 10) -> DataFrame:
    """Top-k categories by fraud rate among those with > min_count rows."""
    return (_rate_by(features, "merchant_category").filter(F.col("total") > min_count)
            .orderBy(F.col("fraud_rate").desc_nulls_first(), F.col("merchant_category").asc_nulls_last())
            .limit(k))


def daily_trend(daily: DataFrame) -> DataFrame:
    """The daily series for the trend chart."""
    return (daily.select("summary_date", "total_transactions", "fraudulent_transactions", "fraud_rate")
            .orderBy(F.col("summary_date").asc_nulls_last()))


def recent_fraud_alerts(features: DataFrame, k: int = 20) -> DataFrame:
    """The k most recent frauds (top-k, not a sort of the whole table)."""
    return (features.filter(F.col("is_fraud"))
            .select("transaction_id", "customer_id", "transaction_timestamp", "amount",
                    "merchant_category", "fraud_risk_tier", "amount_z_score")
            .orderBy(F.col("transaction_timestamp").desc_nulls_first(), F.col("transaction_id").desc())
            .limit(k))


def recent_fraud_alerts_lazy(features: DataFrame, basics: DataFrame, k: int = 20) -> DataFrame:
    """G05 over features that are not stored: the k rows first, then the statistics of their customers alone.

    ``features`` has the ALERT_FEATURES, ``basics`` the transactions that the
    statistics come from.  At most k customers are broadcast.
    """
    from tallyrisk.plans.gold import customer_statistics, z_score

    top = (features.filter(F.col("is_fraud")).orderBy(
        F.col("transaction_timestamp").desc_nulls_first(), F.col("transaction_id").desc()).limit(k))
    own = basics.join(F.broadcast(top.select("customer_id").distinct()), "customer_id", "left_semi")
    rows = top.join(customer_statistics(own), "customer_id", "left").withColumn("amount_abs", F.abs("amount"))
    return (rows.select("transaction_id", "customer_id", "transaction_timestamp", "amount", "merchant_category",
                        "fraud_risk_tier", z_score().alias("amount_z_score"))
            .orderBy(F.col("transaction_timestamp").desc_nulls_first(), F.col("transaction_id").desc()))


def dashboard_pack(features: DataFrame, daily: DataFrame, as_of, days: int = 30) -> dict[str, DataFrame]:
    """The five dashboard queries for the default date range (lazy)."""
    start, end = default_window(as_of, days)
    return {
        "kpi_cards": kpi_cards(features, start, end),
        "fraud_by_hour": fraud_by_hour(features),
        "risky_merchant_categories": risky_merchant_categories(features),
        "daily_trend": daily_trend(daily),
        "recent_fraud_alerts": recent_fraud_alerts(features),
    }
