"""The data contract: raw file schemas, table keys, foreign keys, text limits.

All names, types, keys and limits in this module are fixed values: they must
equal the source system's.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


_TYPES = {
    "INT": T.IntegerType(), "BIGINT": T.LongType(), "STRING": T.StringType(),
    "DATE": T.DateType(), "TIMESTAMP_NTZ": T.TimestampNTZType(), "BOOLEAN": T.BooleanType(),
    "DOUBLE": T.DoubleType(),
}


def _type(name: str) -> T.DataType:
    if name.startswith("DECIMAL("):
        p, s = name[8:-1].split(",")
        return T.DecimalType(int(p), int(s))
    return _TYPES[name]


def _schema(spec: str) -> T.StructType:
    """Parse ``"name TYPE, ..."`` without needing a running session."""
    fields = []
    for part in re.split(r",\s+(?=[a-z_]+ )", spec):
        name, typ = part.strip().split(" ", 1)
        fields.append(T.StructField(name, _type(typ.strip()), True))
    return T.StructType(fields)


# Raw entity files (header row).  Every column is typed up front: nothing is
# inferred, so codes such as zip "01234" keep their leading zeros.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "bronze_customers": _schema(
        "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, phone STRING, "
        "address STRING, city STRING, state STRING, zip_code STRING, date_of_birth DATE, "
        "occupation STRING, income DECIMAL(12,2), credit_score INT, customer_since DATE, "
        "account_manager STRING, segment STRING, risk_level STRING, kyc_status STRING, "
        "last_updated TIMESTAMP_NTZ"),
    "bronze_interactions": _schema(
        "interaction_id BIGINT, customer_id BIGINT, interaction_type STRING, channel STRING, "
        "agent_id BIGINT, date_time TIMESTAMP_NTZ, duration_minutes INT, notes STRING, "
        "outcome STRING, satisfaction_score INT"),
    "bronze_fraud_reports": _schema(
        "report_id BIGINT, customer_id BIGINT, report_date DATE, report_type STRING, "
        "description STRING, status STRING, amount_lost DECIMAL(12,2), "
        "recovery_amount DECIMAL(12,2), investigator STRING, notes STRING"),
    "bronze_accounts": _schema(
        "account_id BIGINT, customer_id BIGINT, account_number STRING, account_type STRING, "
        "opening_date DATE, current_balance DECIMAL(12,2), available_balance DECIMAL(12,2), "
        "currency STRING, status STRING, overdraft_limit DECIMAL(12,2), "
        "interest_rate DECIMAL(5,3), last_updated TIMESTAMP_NTZ"),
    "bronze_transactions": _schema(
        "transaction_id BIGINT, account_id BIGINT, customer_id BIGINT, transaction_date TIMESTAMP_NTZ, "
        "transaction_type STRING, amount DECIMAL(12,2), currency STRING, merchant_name STRING, "
        "merchant_category STRING, merchant_location STRING, transaction_channel STRING, "
        "device_id STRING, ip_address STRING, is_fraud BOOLEAN, status STRING, "
        "description STRING"),
}

LINEAGE_COLUMNS = ["loaded_at", "source_file", "batch_id"]

# --- Fixed values: source file names (must equal the source system's) ------
# Source file -> bronze table.
FILE_TO_TABLE = {
    "crm_customers.csv": "bronze_customers",
    "crm_interactions.csv": "bronze_interactions",
    "crm_fraud_reports.csv": "bronze_fraud_reports",
    "erp_accounts.csv": "bronze_accounts",
    "erp_transactions.csv": "bronze_transactions",
}
# ---------------------------------------------------------------------------

PRIMARY_KEYS: dict[str, list[str]] = {
    "bronze_customers": ["customer_id"],
    "bronze_interactions": ["interaction_id"],
    "bronze_fraud_reports": ["report_id"],
    "bronze_accounts": ["account_id"],
    "bronze_transactions": ["transaction_id"],
    "silver_customers": ["customer_id"],
    "silver_accounts": ["account_id"],
    "silver_transactions": ["transaction_id"],
    "gold_customer_360": ["customer_id"],
    "gold_fraud_features": ["transaction_id"],
    "gold_daily_fraud_summary": ["summary_date"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("bronze_interactions", "customer_id", "bronze_customers", "customer_id"),
    ("bronze_fraud_reports", "customer_id", "bronze_customers", "customer_id"),
    ("bronze_accounts", "customer_id", "bronze_customers", "customer_id"),
    ("bronze_transactions", "account_id", "bronze_accounts", "account_id"),
    ("bronze_transactions", "customer_id", "bronze_customers", "customer_id"),
    ("silver_accounts", "customer_id", "silver_customers", "customer_id"),
    ("silver_transactions", "account_id", "silver_accounts", "account_id"),
    ("silver_transactions", "customer_id", "silver_customers", "customer_id"),
    ("gold_fraud_features", "customer_id", "gold_customer_360", "customer_id"),
    ("gold_fraud_features", "account_id", "silver_accounts", "account_id"),
]

# VARCHAR(n) limits of the silver contract (Spark does not enforce them).
VARCHAR_LIMITS: dict[str, dict[str, int]] = {
    "silver_customers": {
        "full_name": 200, "email": 200, "phone_cleaned": 20, "location_state": 2,
        "location_city": 100, "age_group": 20, "occupation_category": 50,
        "income_bucket": 20, "credit_score_tier": 20, "tenure_group": 20, "segment": 50,
        "risk_tier": 20},
    "silver_accounts": {
        "account_number_masked": 50, "account_type": 50, "account_subtype": 50,
        "age_group": 20, "balance_trend": 20, "interest_rate_tier": 20,
        "account_status": 50},
    "silver_transactions": {
        "transaction_type": 50, "transaction_subtype": 50, "currency": 3,
        "merchant_name": 200, "merchant_name_clean": 200, "merchant_category": 100,
        "merchant_risk_level": 20, "merchant_location": 200, "merchant_state": 2,
        "merchant_country": 2, "transaction_channel": 50, "device_id": 100,
        "ip_address": 50, "hour_group": 20, "fraud_type": 50, "transaction_status": 50},
}

# Columns checked for NULLs by the silver quality check.
NULL_CHECKS: list[tuple[str, str]] = [
    ("silver_customers", "customer_id"),
    ("silver_customers", "risk_score"),
    ("silver_accounts", "account_id"),
    ("silver_accounts", "customer_id"),
    ("silver_transactions", "transaction_id"),
    ("silver_transactions", "account_id"),
]

BRONZE_TABLES = list(RAW_SCHEMAS)
SILVER_TABLES = ["silver_customers", "silver_accounts", "silver_transactions"]
GOLD_TABLES = ["gold_customer_360", "gold_fraud_features", "gold_daily_fraud_summary"]
