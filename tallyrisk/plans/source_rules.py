"""Rules and summaries of the raw source data, as Spark operators.

The source system's data generator carries a few rules worth keeping as
operators over real tables: the fraud-prone cohort (B12), value counts and
headline statistics (D20, D21), the merchant -> category lookup (M-13), signed
amounts for debit types (M-14) and the credit score clamp (M-16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values (must equal the source system's) ---------------------------
FRAUD_PRONE_SEGMENTS = ["Wealth", "Corporate"]
DEBIT_TYPES = ["ATM Withdrawal", "POS Purchase", "Online Payment", "Bill Payment"]
MERCHANT_CATEGORIES = {
    "Walmart": "Retail", "Target": "Retail", "Costco": "Retail",
    "Amazon": "Online Retail", "Netflix": "Entertainment",
    "Starbucks": "Food & Beverage", "Uber": "Transportation",
    "Exxon": "Fuel", "Apple Store": "Electronics",
    "International Casino": "Gambling", "Crypto Exchange": "Cryptocurrency",
}
DEFAULT_CATEGORY = "Other"
CREDIT_SCORE_RANGE = (300, 850)
# -----------------------------------------------------------------------------


def fraud_prone_customers(customers: DataFrame, segments=FRAUD_PRONE_SEGMENTS) -> DataFrame:
    """Customers with High risk level or in a fraud-prone segment."""
    return customers.filter((F.col("risk_level") == "High") | F.col("segment").isin(segments)).select("customer_id")


def value_counts(df: DataFrame, col: str, count_name: str, k: int | None = None) -> DataFrame:
    """Frequency of each value, most frequent first (top-k when ``k``)."""
    out = (df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
           .orderBy(F.col(count_name).desc(), F.col(col).asc_nulls_last()))
    return out.limit(k) if k else out


def global_stats(reports: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Headline statistics of the raw tables as (statistic, value) rows."""
    def long(df: DataFrame) -> DataFrame:
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in df.columns)
        return df.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (statistic, value)")

    r = reports.agg(F.avg(F.col("amount_lost").cast("double")).alias("avg_amount_lost"))
    a = accounts.agg(F.avg(F.col("current_balance").cast("double")).alias("avg_balance"))
    t = transactions.agg(
        F.sum("amount").alias("total_amount"),
        F.avg(F.abs(F.col("amount")).cast("double")).alias("avg_abs_amount"),
        F.count_if(F.col("is_fraud")).alias("fraud_count"),
        (F.avg(F.col("is_fraud").cast("double")) * 100).alias("fraud_rate"))
    return long(r).unionByName(long(a)).unionByName(long(t))


def merchant_category_lookup(spark: SparkSession, transactions: DataFrame, name_col: str = "merchant_name_clean") -> DataFrame:
    """M-13: category from a fixed merchant table (broadcast: 11 rows), default Other."""
    table = spark.createDataFrame(list(MERCHANT_CATEGORIES.items()), "merchant STRING, lookup_category STRING")
    joined = transactions.join(F.broadcast(table), F.col(name_col) == F.col("merchant"), "left")
    return joined.select("transaction_id", name_col,
                         F.coalesce(F.col("lookup_category"), F.lit(DEFAULT_CATEGORY)).alias("lookup_category"))


def signed_amount(transactions: DataFrame) -> DataFrame:
    """M-14: debit transaction types carry a negative amount."""
    a = F.col("amount")
    return transactions.select("transaction_id", "transaction_type",
                               F.when(F.col("transaction_type").isin(DEBIT_TYPES), -F.abs(a)).otherwise(a)
                               .alias("signed_amount"))


def clamp_credit_score(customers: DataFrame) -> DataFrame:
    """M-16: credit score held inside the valid range."""
    lo, hi = CREDIT_SCORE_RANGE
    return customers.select("customer_id",
                            F.greatest(F.lit(lo), F.least(F.lit(hi), F.col("credit_score"))).alias("clamped_score"))
