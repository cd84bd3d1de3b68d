"""Silver layer: cleaned, typed and enriched entities (one row per source row).

Each builder is a lazy function of bronze frames and ``as_of``.  Keyed
aggregates are computed before they are joined back (aggregate below join),
so the fact side is never multiplied and the join inputs are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.functions import rules
from tallyrisk.functions.rules import bin_with, flag
from tallyrisk.functions.temporal import (
    age_years, as_of_date, as_of_ts, elapsed_days_floor, is_business_hours,
    is_night, is_weekend, time_of_day,
)
from tallyrisk.functions.text import digits_only, full_name, location_state, mask_tail, strip_ws
from tallyrisk.operators import aggregates as agg
from tallyrisk.operators.joins import join_dimension, left_join_fill

MONEY = "decimal(12,2)"
# Counts and sums are wider than the source DDL (INTEGER, NUMERIC(12,2)):
# at 100 TB a busy customer, account or day exceeds those ranges, and an
# overflow under ANSI would stop the job.  Values that fit are unchanged.
COUNT = "bigint"
SUM_MONEY = "decimal(22,2)"


def _null_str():
    return F.lit(None).cast("string")

SILVER_CUSTOMER_COLUMNS = [
    "customer_id", "full_name", "email", "phone_cleaned", "location_state", "location_city",
    "age", "age_group", "occupation_category", "income_bucket", "credit_score",
    "credit_score_tier", "customer_tenure_days", "tenure_group", "segment", "risk_score",
    "risk_tier", "kyc_verified", "total_accounts", "total_balance", "avg_account_balance",
    "last_interaction_date", "total_interactions", "complaint_count", "has_fraud_history",
    "fraud_report_count", "total_fraud_loss", "created_at", "updated_at", "source_customer_id",
]


def customer_basics(customers: DataFrame, as_of) -> DataFrame:
    """The customer columns other tables are enriched with (same values as silver)."""
    return customers.select("customer_id", age_years(as_of, F.col("date_of_birth")).alias("age"),
                            rules.risk_level_score(F.col("risk_level")).alias("risk_score"))


def account_basics(accounts: DataFrame, as_of) -> DataFrame:
    """The account columns other tables are enriched with (same values as silver)."""
    return accounts.select("account_id", "current_balance",
                           F.datediff(as_of_date(as_of), F.col("opening_date")).alias("account_age_days"))


def silver_customers(customers: DataFrame, interactions: DataFrame, fraud_reports: DataFrame,
                     accounts: DataFrame, as_of, matched: str | None = None) -> DataFrame:
    """Customers with demographics, tiers, contact, fraud and account totals.

    The account totals (D05) are joined in the same plan instead of a later
    UPDATE (C07): customers without an account keep 0.  ``matched``: name of a
    further column that tells whether the customer met account totals.
    """
    now = as_of_ts(as_of)
    c = customers.select(
        "customer_id", "email", "credit_score", "segment",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        digits_only(F.col("phone")).alias("phone_cleaned"),
        F.col("state").alias("location_state"),
        F.col("city").alias("location_city"),
        age_years(as_of, F.col("date_of_birth")).alias("age"),
        rules.occupation_category(F.col("occupation")).alias("occupation_category"),
        bin_with(F.col("income"), rules.INCOME_BINS).alias("income_bucket"),
        rules.credit_tier(F.col("credit_score")).alias("credit_score_tier"),
        F.datediff(as_of_date(as_of), F.col("customer_since")).alias("customer_tenure_days"),
        rules.risk_level_score(F.col("risk_level")).alias("risk_score"),
        F.col("kyc_status").eqNullSafe("Verified").alias("kyc_verified"),
    ).withColumns({
        "age_group": bin_with(F.col("age"), rules.AGE_BINS),
        "tenure_group": bin_with(F.col("customer_tenure_days") / F.lit(365.0), rules.TENURE_BINS),
    })
    c = left_join_fill(c, agg.interaction_stats(interactions), "customer_id",
                       {"total_interactions": 0, "complaint_count": 0})
    c = left_join_fill(c, agg.fraud_report_stats(fraud_reports), "customer_id",
                       {"fraud_report_count": 0, "total_fraud_loss": 0})
    totals = agg.customer_account_totals(accounts)
    if matched:
        totals = totals.withColumn(matched, F.lit(True))
    c = left_join_fill(c, totals, "customer_id",
                       {"total_accounts": 0, "total_balance": 0, "avg_account_balance": 0} | ({matched: False} if matched else {}))
    return c.select(
        "customer_id", "full_name", "email", "phone_cleaned", "location_state", "location_city",
        "age", "age_group", "occupation_category", "income_bucket", "credit_score",
        "credit_score_tier", "customer_tenure_days", "tenure_group", "segment", "risk_score",
        _null_str().alias("risk_tier"), "kyc_verified",
        F.col("total_accounts").cast(COUNT).alias("total_accounts"),
        F.col("total_balance").cast(SUM_MONEY).alias("total_balance"),
        F.col("avg_account_balance").cast(MONEY).alias("avg_account_balance"),
        F.to_date("last_interaction_date").alias("last_interaction_date"),
        F.col("total_interactions").cast(COUNT).alias("total_interactions"),
        F.col("complaint_count").cast(COUNT).alias("complaint_count"),
        (F.col("fraud_report_count") > 0).alias("has_fraud_history"),
        F.col("fraud_report_count").cast(COUNT).alias("fraud_report_count"),
        F.col("total_fraud_loss").cast(SUM_MONEY).alias("total_fraud_loss"),
        now.alias("created_at"), now.alias("updated_at"),
        F.col("customer_id").alias("source_customer_id"), *([matched] if matched else []),
    )


SILVER_ACCOUNT_COLUMNS = [
    "account_id", "customer_id", "account_number_masked", "account_type", "account_subtype",
    "opening_date", "account_age_days", "age_group", "last_activity_date", "current_balance",
    "available_balance", "average_balance_30d", "balance_trend", "has_overdraft",
    "overdraft_utilization", "interest_rate_tier", "account_status", "is_active",
    "avg_daily_transactions", "total_transactions_30d", "last_transaction_date",
    "days_since_last_transaction", "fraud_transaction_count", "fraud_amount_total",
    "created_at", "updated_at",
]


def silver_accounts(accounts: DataFrame, transactions: DataFrame, as_of) -> DataFrame:
    """Accounts with masking, age, overdraft use, 30-day and fraud activity."""
    now = as_of_ts(as_of)
    limit = F.col("overdraft_limit")
    has_od = flag(limit > 0)
    util = (limit - F.col("available_balance")) / limit
    a = accounts.select(
        "account_id", "customer_id", "account_type", "opening_date", "current_balance",
        "available_balance",
        mask_tail(F.col("account_number")).alias("account_number_masked"),
        F.datediff(as_of_date(as_of), F.col("opening_date")).alias("account_age_days"),
        has_od.alias("has_overdraft"),
        F.when(has_od, F.when(util.isNull(), F.lit(None))
               .otherwise(F.greatest(F.lit(0), F.least(F.lit(1), util))))
         .otherwise(F.lit(0)).cast("double").alias("overdraft_utilization"),
        bin_with(F.col("interest_rate"), rules.INTEREST_BINS).alias("interest_rate_tier"),
        F.col("status").alias("account_status"),
        F.col("status").eqNullSafe("Active").alias("is_active"),
    ).withColumn("age_group", bin_with(F.col("account_age_days"), rules.ACCOUNT_AGE_BINS))
    a = left_join_fill(a, agg.account_txn_window(transactions, as_of), "account_id",
                       {"total_transactions_30d": 0, "avg_daily_transactions": 0})
    a = left_join_fill(a, agg.account_fraud_totals(transactions), "account_id",
                       {"fraud_transaction_count": 0, "fraud_amount_total": 0})
    last_ts = F.col("last_transaction_ts")
    return a.select(
        "account_id", "customer_id", "account_number_masked", "account_type",
        _null_str().alias("account_subtype"), "opening_date", "account_age_days", "age_group",
        F.to_date(last_ts).alias("last_activity_date"),
        "current_balance", "available_balance",
        F.lit(None).cast(MONEY).alias("average_balance_30d"),
        _null_str().alias("balance_trend"), "has_overdraft",
        F.col("overdraft_utilization").cast("decimal(5,3)").alias("overdraft_utilization"),
        "interest_rate_tier", "account_status", "is_active",
        F.col("avg_daily_transactions").cast(MONEY).alias("avg_daily_transactions"),
        F.col("total_transactions_30d").cast(COUNT).alias("total_transactions_30d"),
        F.to_date(last_ts).alias("last_transaction_date"),
        F.coalesce(elapsed_days_floor(now, last_ts), F.lit(999)).alias("days_since_last_transaction"),
        F.col("fraud_transaction_count").cast(COUNT).alias("fraud_transaction_count"),
        F.col("fraud_amount_total").cast(SUM_MONEY).alias("fraud_amount_total"),
        now.alias("created_at"), now.alias("updated_at"),
    )


SILVER_TRANSACTION_COLUMNS = [
    "transaction_id", "account_id", "customer_id", "transaction_timestamp", "transaction_date",
    "transaction_time", "transaction_type", "transaction_subtype", "amount", "amount_abs",
    "currency", "merchant_name", "merchant_name_clean", "merchant_category",
    "merchant_risk_level", "merchant_location", "merchant_state", "merchant_country",
    "transaction_channel", "device_id", "ip_address", "transaction_hour", "hour_group",
    "is_weekend", "is_night", "is_holiday", "is_business_hours", "customer_age",
    "customer_risk_score", "account_balance", "is_fraud", "fraud_type", "transaction_status",
    "created_at",
]


def transaction_basics(transactions: DataFrame) -> DataFrame:
    """Transactions with time features and merchant cleanup, one row each, joined to nothing.

    What needs no customer or account context (statistics, daily totals,
    reports by hour or category) reads this and not the enriched table.
    """
    ts = F.col("transaction_date")
    hour = F.hour(ts)
    weekend = is_weekend(ts)
    return transactions.select(
        "transaction_id", "account_id", "customer_id", "transaction_type", "amount", "currency",
        "merchant_category", "merchant_location", "transaction_channel", "device_id",
        "ip_address", "is_fraud",
        ts.alias("transaction_timestamp"),
        F.to_date(ts).alias("transaction_date"),
        time_of_day(ts).alias("transaction_time"),
        F.abs("amount").alias("amount_abs"),
        strip_ws(F.col("merchant_name")).alias("merchant_name_clean"),
        rules.merchant_risk_level(F.col("merchant_name")).alias("merchant_risk_level"),
        location_state(F.col("merchant_location")).alias("merchant_state"),
        hour.alias("transaction_hour"),
        bin_with(hour, rules.HOUR_BINS, right=False).alias("hour_group"),
        weekend.alias("is_weekend"),
        is_night(hour).alias("is_night"),
        is_business_hours(hour, weekend).alias("is_business_hours"),
        F.col("status").alias("transaction_status"),
    )


def silver_transactions(transactions: DataFrame, customers: DataFrame, accounts: DataFrame,
                        as_of) -> DataFrame:
    """Transactions with time features, merchant cleanup and customer/account context.

    ``customers`` / ``accounts`` are silver frames (or anything with
    ``customer_id, age, risk_score`` / ``account_id, current_balance``), unique
    on their keys by contract (checked by Q05).  They are joined as they are:
    an aggregate on the key between exchange and join would keep the skew
    split from a hot customer's or account's rows.
    """
    now = as_of_ts(as_of)
    t = transaction_basics(transactions)
    cust = customers.select("customer_id", F.col("age").alias("customer_age"),
                            F.col("risk_score").alias("customer_risk_score"))
    acct = accounts.select("account_id", F.col("current_balance").alias("account_balance"))
    t = join_dimension(t, cust, "customer_id")
    t = join_dimension(t, acct, "account_id")
    return t.select(
        "transaction_id", "account_id", "customer_id", "transaction_timestamp", "transaction_date",
        "transaction_time", "transaction_type", _null_str().alias("transaction_subtype"),
        "amount", "amount_abs", "currency", _null_str().alias("merchant_name"),
        "merchant_name_clean", "merchant_category", "merchant_risk_level", "merchant_location",
        "merchant_state", _null_str().alias("merchant_country"), "transaction_channel", "device_id",
        "ip_address", "transaction_hour", "hour_group", "is_weekend", "is_night",
        F.lit(None).cast("boolean").alias("is_holiday"), "is_business_hours",
        "customer_age", "customer_risk_score", "account_balance", "is_fraud",
        _null_str().alias("fraud_type"), "transaction_status", now.alias("created_at"),
    )
