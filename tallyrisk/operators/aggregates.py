"""Keyed aggregates.

Every aggregate here is decomposable (count, sum, min, max, avg, stddev), so
Spark computes a partial aggregate per input partition before the shuffle:
a key holding a third of all rows sends one partial row per map task, not
its rows.  The only exact distinct count is D08's, planned as a two-level
aggregate on (day, customer), which is also partial-combined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.functions.temporal import midnight_days_ago

MONEY = "decimal(12,2)"


def interaction_stats(interactions: DataFrame) -> DataFrame:
    """Last contact, number of contacts and complaints per customer."""
    return interactions.groupBy("customer_id").agg(
        F.max("date_time").alias("last_interaction_date"),
        F.count(F.lit(1)).alias("total_interactions"),
        F.count_if(F.col("interaction_type") == "complaint").alias("complaint_count"),
    )


def fraud_report_stats(reports: DataFrame) -> DataFrame:
    """Number of fraud reports and money lost per customer."""
    return reports.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("fraud_report_count"),
        F.sum("amount_lost").alias("total_fraud_loss"),
    )


def account_txn_window(txns: DataFrame, as_of, days: int = 30, ts: str = "transaction_date") -> DataFrame:
    """Per account over the last ``days`` days (midnight-anchored, strict)."""
    recent = txns.filter(F.col(ts) > midnight_days_ago(as_of, days))
    return recent.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("total_transactions_30d"),
        F.max(ts).alias("last_transaction_ts"),
        F.avg(F.abs("amount")).alias("avg_daily_transactions"),
    )


def account_fraud_totals(txns: DataFrame) -> DataFrame:
    """All-time fraud count and absolute fraud amount per account."""
    return txns.filter(F.col("is_fraud")).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("fraud_transaction_count"),
        F.sum(F.abs("amount")).alias("fraud_amount_total"),
    )


def customer_account_totals(accounts: DataFrame) -> DataFrame:
    """Number of accounts, total and mean balance per customer."""
    return accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.sum("current_balance").alias("total_balance"),
        F.avg("current_balance").alias("avg_account_balance"),
    )


def customer_spend_window(txns: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Activity per customer over the last ``days`` days; spend = debits only."""
    recent = txns.filter(F.col("transaction_timestamp") > midnight_days_ago(as_of, days))
    return recent.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("transaction_count_30d"),
        F.sum(F.when(F.col("amount") < 0, F.col("amount_abs")).otherwise(F.lit(0))).alias("total_spent_30d"),
        F.avg("amount_abs").alias("avg_transaction_value"),
        F.max("transaction_timestamp").alias("last_transaction_date"),
    )


def customer_fraud_window(txns: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Frauds per customer over the last ``days`` days."""
    recent = txns.filter(F.col("is_fraud") &
                         (F.col("transaction_timestamp") > midnight_days_ago(as_of, days)))
    return recent.groupBy("customer_id").agg(F.count(F.lit(1)).alias("fraud_count_90d"))


def daily_fraud_totals(txns: DataFrame) -> DataFrame:
    """Per calendar day totals and the exact number of active customers."""
    return (txns.groupBy(F.to_date("transaction_timestamp").alias("summary_date")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(F.col("is_fraud")).alias("fraudulent_transactions"),
        F.sum("amount_abs").alias("total_amount"),
        F.sum(F.when(F.col("is_fraud"), F.col("amount_abs")).otherwise(F.lit(0))).alias("fraud_amount"),
        F.count_distinct("customer_id").alias("affected_customers"),
    ))


def daily_fraud_victims(txns: DataFrame) -> DataFrame:
    """D08 corrected (S19): customers with at least one fraud that day.

    The source's ``affected_customers`` counts every customer active on the
    day; this is the number of fraud victims.  Exact distinct count, planned
    as a two-level aggregate on (day, customer).
    """
    fraud = txns.filter(F.col("is_fraud"))
    days = txns.select(F.to_date("transaction_timestamp").alias("summary_date")).distinct()
    victims = fraud.groupBy(F.to_date("transaction_timestamp").alias("summary_date")).agg(
        F.count_distinct("customer_id").alias("fraud_victims"))
    return days.join(victims, "summary_date", "left").select(
        "summary_date", F.coalesce(F.col("fraud_victims"), F.lit(0)).alias("fraud_victims"))
