"""Layer verification reports: distributions, samples and headline statistics.

The sample queries order by the key before ``limit`` so that the rows shown
are deterministic (a top-k, not a full sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Fixed values (must equal the source system's) --------------------------
HOUR_GROUP_ORDER = ["Late Night", "Morning", "Afternoon", "Evening", "Night"]
# ---------------------------------------------------------------------------


def segment_by_risk(customers: DataFrame) -> DataFrame:
    """Customers per (segment, risk score) with mean balance and credit score."""
    return (customers.groupBy("segment", "risk_score").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.avg(F.col("total_balance").cast("double")).alias("avg_balance"),
        F.avg(F.col("credit_score").cast("double")).alias("avg_credit_score"))
        .orderBy(F.col("segment").asc_nulls_last(), F.col("risk_score").asc_nulls_last()))


def account_type_distribution(accounts: DataFrame) -> DataFrame:
    """Accounts per type, mean balance, active accounts, mean age in years."""
    return (accounts.groupBy("account_type").agg(
        F.count(F.lit(1)).alias("account_count"),
        F.avg(F.col("current_balance").cast("double")).alias("avg_balance"),
        F.sum(F.when(F.col("is_active"), 1).otherwise(0)).alias("active_count"),
        (F.avg(F.col("account_age_days").cast("double")) / F.lit(365)).alias("avg_age_years"))
        .orderBy(F.col("account_count").desc(), F.col("account_type").asc_nulls_last()))


def fraud_statistics(transactions: DataFrame) -> DataFrame:
    """Per fraud label: count, mean and total absolute amount, customers."""
    return transactions.groupBy("is_fraud").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg(F.col("amount_abs").cast("double")).alias("avg_amount"),
        F.sum("amount_abs").alias("total_amount"),
        F.count_distinct("customer_id").alias("unique_customers"))


def fraud_by_hour_group(transactions: DataFrame) -> DataFrame:
    """Fraud share per time-of-day group, in clock order."""
    order = None
    for i, g in enumerate(HOUR_GROUP_ORDER, start=1):
        cond = F.col("hour_group") == g
        order = F.when(cond, i) if order is None else order.when(cond, i)
    fraud01 = F.when(F.col("is_fraud"), 1).otherwise(0)
    return (transactions.groupBy("hour_group").agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.sum(fraud01).alias("fraud_txns"))
        .withColumn("fraud_rate", F.round(F.lit(100.0) * F.col("fraud_txns") / F.col("total_txns"), 2))
        .orderBy(order.asc_nulls_last()))


def batch_info(bronze: DataFrame) -> DataFrame:
    """First and last load time per batch."""
    return bronze.groupBy("batch_id").agg(F.min("loaded_at").alias("earliest_load"),
                                          F.max("loaded_at").alias("latest_load"))


def fraud_count(transactions: DataFrame) -> DataFrame:
    """Q07: number of fraudulent transactions."""
    return transactions.agg(F.count_if(F.col("is_fraud")).alias("fraud_count"))


def sample(df: DataFrame, cols: list[str], key: str, n: int, where=None) -> DataFrame:
    """First ``n`` rows by key."""
    if where is not None:
        df = df.filter(where)
    return df.select(*cols).orderBy(F.col(key)).limit(n)


def last_days(daily: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` latest days of the summary."""
    return (daily.select("summary_date", "total_transactions", "fraudulent_transactions", "fraud_rate")
            .orderBy(F.col("summary_date").desc_nulls_last()).limit(n))
