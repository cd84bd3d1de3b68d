"""Gold layer: customer profile, per-transaction risk features, daily summary.

Columns the source system only reserved (it stores constants or random
numbers there) are produced the same way by default (``parity=True``); the
placeholders that were random use a hash of the transaction id instead, so a
rerun or a retried task gives the same value.  Real definitions of those
columns are in :mod:`tallyrisk.operators.velocity`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.functions import rules
from tallyrisk.functions.rules import bin_with, flag
from tallyrisk.functions.temporal import as_of_date, as_of_ts, hour_angle
from tallyrisk.operators import aggregates as agg
from tallyrisk.operators.joins import join_dimension, left_join_fill
from tallyrisk.operators.sequence import with_sequence_features
from tallyrisk.session import stored

MONEY = "decimal(12,2)"
# Wider than the source DDL where 100 TB values would not fit (see silver.py).
COUNT = "bigint"
SUM_MONEY = "decimal(22,2)"
# --- Fixed values (must equal the source system's) --------------------------
MODEL_VERSION = "v1.0"
# ---------------------------------------------------------------------------


def customer_360(customers: DataFrame, transactions: DataFrame, as_of) -> DataFrame:
    """One profile row per silver customer."""
    now = as_of_ts(as_of)
    c = left_join_fill(customers, agg.customer_spend_window(transactions, as_of), "customer_id",
                       {"transaction_count_30d": 0, "total_spent_30d": 0, "avg_transaction_value": 0})
    c = left_join_fill(c, agg.customer_fraud_window(transactions, as_of), "customer_id",
                       {"fraud_count_90d": 0})
    return c.select(
        "customer_id", "full_name",
        F.col("segment").alias("demographic_segment"),
        F.col("location_state").alias("location_tier"),
        F.col("total_balance").alias("total_relationship_balance"),
        "avg_account_balance", "credit_score_tier", "income_bucket",
        F.col("transaction_count_30d").cast(COUNT).alias("transaction_count_30d"),
        F.col("total_spent_30d").cast(SUM_MONEY).alias("total_spent_30d"),
        F.col("avg_transaction_value").cast(MONEY).alias("avg_transaction_value"),
        F.col("risk_score").alias("overall_risk_score"),
        F.col("tenure_group").alias("risk_tier"),
        # reports / 10 (a placeholder score): (12,4) so 100+ reports cannot overflow
        (F.col("fraud_report_count") / F.lit(10.0)).cast("decimal(12,4)").alias("fraud_probability"),
        F.col("last_interaction_date").alias("last_support_call"),
        F.col("complaint_count").alias("complaint_count_90d"),
        F.lit(None).cast("decimal(3,2)").alias("satisfaction_score_avg"),
        flag(F.col("total_balance") > rules.HIGH_VALUE_BALANCE).alias("is_high_value"),
        flag((F.col("risk_score") >= 2) & (F.col("fraud_count_90d") > 0)).alias("is_at_risk"),
        (~F.col("kyc_verified")).alias("needs_kyc_review"),
        as_of_date(as_of).alias("snapshot_date"),
        now.alias("created_at"),
    )


#: Multipliers of the placeholder hashes, by column.
SALTS = {"merchant_risk": 40_503, "distance": 30_011, "velocity": 51_787}


def _id_hash(salt: str) -> Column:
    """A value below 2**31 from the transaction id alone (any partitioning, any engine with 64-bit integers).

    Three rounds of multiply, add and modulo over 31 bits: none exceeds 2**62.
    """
    h = F.pmod(F.col("transaction_id").cast("long"), F.lit(ROUND_MODULUS))
    for _ in range(3):
        h = F.pmod(h * F.lit(SALTS[salt]) + F.lit(12_345), F.lit(ROUND_MODULUS))
    return h


ROUND_MODULUS = 2_147_483_647


FEATURE_COLUMNS = [
    "transaction_id", "customer_id", "account_id", "transaction_timestamp", "amount",
    "amount_category", "customer_age", "customer_tenure_days", "customer_risk_score",
    "customer_avg_daily_spend", "customer_transaction_frequency", "account_age_days",
    "account_balance", "balance_change_24h", "account_transaction_count_7d", "merchant_category",
    "merchant_risk_score", "is_new_merchant_for_customer", "transaction_hour", "is_night_time",
    "is_weekend", "is_holiday", "days_since_last_transaction", "hour_of_day_sin",
    "hour_of_day_cos", "transaction_count_1h", "transaction_count_24h", "transaction_amount_24h",
    "unique_merchants_24h", "is_new_device", "is_new_location", "distance_from_home_km",
    "velocity_kmh", "amount_z_score", "time_since_avg", "amount_deviation_from_avg", "is_fraud",
    "fraud_probability", "fraud_risk_tier", "model_version", "prediction_timestamp", "created_at",
]


# What a feature column needs beside the transaction itself.
SEQUENCE_COLUMNS = {"customer_avg_daily_spend", "customer_transaction_frequency", "is_new_merchant_for_customer",
                    "days_since_last_transaction", "amount_z_score", "time_since_avg", "amount_deviation_from_avg"}
ACCOUNT_COLUMNS = {"customer_tenure_days", "account_age_days"}
CONTEXT_COLUMNS = {"customer_age", "customer_risk_score", "account_balance", "fraud_risk_tier"}


def fraud_features(transactions: DataFrame, accounts: DataFrame, as_of,
                   bucket_hours: int = 24, parity: bool = True,
                   holidays: DataFrame | None = None, rows_per_bucket: int | None = 2_000_000,
                   bucket_col: str | None = None, prehashed: bool = False,
                   basics: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """H06 (flagship): one feature row per silver transaction.

    ``transactions`` is silver_transactions, ``accounts`` silver_accounts
    (only ``account_id, account_age_days`` are read).  Rows without a
    customer cannot be placed in a customer sequence; they are reported by
    :func:`tallyrisk.operators.quality.rejected_feature_rows`, which the gold
    run publishes.

    ``parity=False`` fills the reserved columns with their real definitions
    (rolling counts and sums, first device/location, category risk score,
    and holidays when a ``holiday_date`` table is given); this adds the
    passes of :mod:`tallyrisk.operators.velocity`.

    ``rows_per_bucket``: a customer's day with more transactions than this is
    cut into shorter stretches, so a burst of one customer is split over tasks.
    ``bucket_col`` / ``prehashed``: read from a table bucketed on
    (customer_id, bucket_col), the sequence step reuses that layout instead of
    shuffling the rows (:func:`tallyrisk.plans.runs.run_gold`).
    ``basics``: the transactions before enrichment, where at hand; passes that
    need no context read them.  ``columns``: the wanted columns; steps that
    none of them comes from are left out, the rows stay the same.
    """
    wanted = FEATURE_COLUMNS if columns is None else columns
    basics = transactions if basics is None else basics
    need = set(wanted)
    source = transactions if need & CONTEXT_COLUMNS or not parity else basics
    t = source
    if not parity:  # over all rows: an account's sums count its rows without a customer
        from tallyrisk.operators import velocity

        t = velocity.with_velocity(t, rows_per_bucket)
    t = t.filter(F.col("customer_id").isNotNull())
    if not parity:
        t = _with_category_risk(t, velocity.merchant_category_risk(basics))
        if holidays is not None:
            t = velocity.with_holidays(t.drop("is_holiday"), holidays)
    if need & SEQUENCE_COLUMNS:
        t = with_sequence_features(t, bucket_hours=bucket_hours, rows_per_bucket=rows_per_bucket,
                                   bucket_col=bucket_col, prehashed=prehashed,
                                   basics=basics.filter(F.col("customer_id").isNotNull()))
    if need & ACCOUNT_COLUMNS:
        t = join_dimension(t, accounts.select("account_id", "account_age_days"), "account_id")
    exprs = _feature_exprs(as_of) | ({} if parity else _real_exprs(holidays is not None))
    return t.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in wanted])


def _feature_exprs(as_of) -> dict[str, Column]:
    """Columns that are not taken over as they are."""
    now = as_of_ts(as_of)
    x = F.col("amount_abs").cast("double")
    mean = F.col("_mean_value")
    hours = F.coalesce(F.timestamp_diff("MICROSECOND", F.col("_prev_ts"), F.col("transaction_timestamp"))
                       / F.lit(3.6e9), F.lit(24.0))
    hour = F.col("transaction_hour")
    zero_money, zero_count = F.lit(0).cast(SUM_MONEY), F.lit(0).cast(COUNT)
    return {
        "amount_category": bin_with(F.col("amount_abs"), rules.AMOUNT_BINS),
        "customer_tenure_days": F.col("account_age_days"),
        "customer_avg_daily_spend": (mean / F.lit(30.0)).cast(MONEY),
        "customer_transaction_frequency": (F.col("_n_value") / F.lit(30.0)).cast("decimal(20,2)"),
        "balance_change_24h": zero_money,
        "account_transaction_count_7d": zero_count,
        "merchant_risk_score": (F.lit(1) + F.pmod(_id_hash("merchant_risk"), F.lit(9))).cast("int"),
        "is_new_merchant_for_customer": F.col("_is_first_group"),
        "is_night_time": F.col("is_night"),
        "is_holiday": F.lit(False),
        "days_since_last_transaction": F.round(hours / F.lit(24.0)).cast("int"),
        "hour_of_day_sin": hour_angle(hour, "sin").cast("decimal(10,8)"),
        "hour_of_day_cos": hour_angle(hour, "cos").cast("decimal(10,8)"),
        "transaction_count_1h": zero_count,
        "transaction_count_24h": zero_count,
        "transaction_amount_24h": zero_money,
        "unique_merchants_24h": zero_count,
        "is_new_device": F.lit(False),
        "is_new_location": F.lit(False),
        "distance_from_home_km": (F.pmod(_id_hash("distance"), F.lit(10_000)) / 100).cast("decimal(10,2)"),
        "velocity_kmh": (F.pmod(_id_hash("velocity"), F.lit(12_000)) / 100).cast("decimal(10,2)"),
        "amount_z_score": z_score(),
        "time_since_avg": (hours / F.col("_mean_gap_hours")).cast("decimal(20,2)"),
        "amount_deviation_from_avg": (x - mean).cast(MONEY),
        "fraud_probability": F.when(F.col("is_fraud"), 1.0).otherwise(0.0).cast("decimal(5,4)"),
        "fraud_risk_tier": rules.fraud_risk_tier(F.col("customer_risk_score")),
        "model_version": F.lit(MODEL_VERSION),
        "prediction_timestamp": now,
        "created_at": now,
    }


def customer_statistics(basics: DataFrame) -> DataFrame:
    """(customer_id, _mean_value, _std_value): the statistics behind amount_z_score, from the same summary."""
    from tallyrisk.operators.sequence import Cells, group_summary, with_cells

    t = with_cells(basics.filter(F.col("customer_id").isNotNull()), "customer_id", "transaction_timestamp",
                   "transaction_id", Cells(24))
    s = group_summary(t, "customer_id", "transaction_timestamp", "amount_abs", "merchant_category")
    return s.groupBy("customer_id").agg(F.any_value("_mean_value").alias("_mean_value"),
                                        F.any_value("_std_value").alias("_std_value"))


def z_score() -> Column:
    mean, std = F.col("_mean_value"), F.col("_std_value")
    return F.when(std > 0, (F.col("amount_abs").cast("double") - mean) / std).otherwise(F.lit(0.0)).cast("decimal(16,4)")


def _real_exprs(holidays: bool) -> dict[str, Column]:
    from tallyrisk.operators.velocity import VELOCITY_COLUMNS

    names = [*VELOCITY_COLUMNS, "merchant_risk_score", *(["is_holiday"] if holidays else [])]
    return {c: F.col(c) for c in names}


def _with_category_risk(t: DataFrame, risk: DataFrame) -> DataFrame:
    """``merchant_risk_score`` of the row's category (NULL being one).

    The scores, one row a category, are stored first (a job at once): their
    size is then known, so a small table is broadcast and a large one joined
    as a scan, whose hot categories the skew join splits.
    """
    score = stored(risk.select(F.col("merchant_category").alias("_cat"), "merchant_risk_score"), "category-risk")
    return join_dimension(t, score, t["merchant_category"].eqNullSafe(F.col("_cat"))).drop("_cat")


DAILY_COLUMNS = [
    "summary_date", "total_transactions", "fraudulent_transactions", "fraud_rate",
    "total_amount", "fraud_amount", "avg_fraud_amount", "fraud_by_channel",
    "fraud_by_merchant_category", "fraud_by_hour", "affected_customers", "repeat_victims",
    "auto_detected_count", "reported_count", "detection_lag_hours", "created_at", "updated_at",
]


def daily_fraud_summary(transactions: DataFrame, as_of) -> DataFrame:
    """One row per calendar day with totals, fraud rate and fraud amounts."""
    now = as_of_ts(as_of)
    d = agg.daily_fraud_totals(transactions)
    fraud_n = F.col("fraudulent_transactions")
    return d.select(
        "summary_date",
        F.col("total_transactions").cast(COUNT).alias("total_transactions"),
        fraud_n.cast(COUNT).alias("fraudulent_transactions"),
        F.try_divide(fraud_n, F.col("total_transactions")).cast("decimal(5,4)").alias("fraud_rate"),
        F.col("total_amount").cast(SUM_MONEY).alias("total_amount"),
        F.col("fraud_amount").cast(SUM_MONEY).alias("fraud_amount"),
        F.try_divide(F.col("fraud_amount"), F.nullif(fraud_n, F.lit(0)))
        .cast(MONEY).alias("avg_fraud_amount"),
        F.lit("{}").alias("fraud_by_channel"),
        F.lit("{}").alias("fraud_by_merchant_category"),
        F.lit("{}").alias("fraud_by_hour"),
        F.col("affected_customers").cast(COUNT).alias("affected_customers"),
        F.lit(0).cast(COUNT).alias("repeat_victims"),
        F.expr("fraudulent_transactions div 2").cast(COUNT).alias("auto_detected_count"),
        F.expr("fraudulent_transactions div 2").cast(COUNT).alias("reported_count"),
        F.lit(0).cast("decimal(10,2)").alias("detection_lag_hours"),
        now.alias("created_at"), now.alias("updated_at"),
    )
