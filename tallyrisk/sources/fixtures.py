"""Bank-shaped bronze frames derived from the driver's generic test tables.

The test data has no bank tables, so each bronze entity is mapped from an
existing table by plain SQL expressions (see FIXTURES.md §2).  The same
expression text is used by the DuckDB oracle, so both engines see identical
inputs.  Every row of the source tables is used; the frames grow with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.schemas import RAW_SCHEMAS

CUSTOMER_EXPRS = {
    "customer_id": "cast(c_custkey as bigint)",
    "first_name": "case when c_custkey % 103 = 0 then null else 'Customer' end",
    "last_name": "substr(c_name, 10)",
    "email": "concat(lower(c_name), '@example.com')",
    "phone": "concat('+1 (555) ', lpad(cast(c_custkey as string), 7, '0'))",
    "city": "n_name",
    "state": "concat('S', cast(c_nationkey % 10 as string))",
    "zip_code": "lpad(cast(c_custkey as string), 5, '0')",
    "date_of_birth": "case when c_custkey % 97 = 0 then date '1920-01-01' "
                     "else date '1944-01-01' + cast((c_custkey * 37) % 22000 as int) end",
    "occupation": "case c_custkey % 8 when 0 then 'Software engineer' when 1 then 'Sales executive' "
                  "when 2 then 'Nurse' when 3 then 'Teacher' when 4 then 'Marketing lead' "
                  "when 5 then 'Sales engineer' when 6 then 'Painter' end",
    "income": "cast(case when c_custkey % 101 = 0 then 0 else (c_custkey * 7919) % 200000 end as decimal(12,2))",
    "credit_score": "cast(case when c_custkey % 89 = 0 then null else 500 + (c_custkey * 7919) % 351 end as int)",
    "customer_since": "case when c_custkey % 83 = 0 then date '2024-02-03' "
                      "else date '2012-01-01' + cast((c_custkey * 53) % 4400 as int) end",
    "segment": "c_mktsegment",
    "risk_level": "case when c_custkey % 79 = 0 then null else case c_custkey % 3 when 0 then 'Low' "
                  "when 1 then 'Medium' else 'High' end end",
    "kyc_status": "case when c_custkey % 73 = 0 then null else case c_custkey % 5 when 1 then 'Pending' "
                  "when 2 then 'Expired' else 'Verified' end end",
}

ACCOUNT_EXPRS = {
    "account_id": "cast(c_custkey * 10 + j as bigint)",
    "customer_id": "cast(c_custkey as bigint)",
    "account_number": "concat('ACCT', lpad(cast(c_custkey * 10 + j as string), 10, '0'))",
    "account_type": "case (c_custkey + j) % 4 when 0 then 'Checking' when 1 then 'Savings' "
                    "when 2 then 'Money Market' else 'Certificate of Deposit' end",
    "opening_date": "date '2015-01-01' + cast(((c_custkey * 10 + j) * 31) % 3321 as int)",
    "current_balance": "cast(c_acctbal as decimal(12,2)) * (j + 1) * 5",
    "available_balance": "cast(c_acctbal as decimal(12,2)) * (j + 1) * 5 - (c_custkey * 10 + j) % 500",
    "currency": "'USD'",
    "status": "case (c_custkey + j) % 5 when 3 then 'Dormant' when 4 then 'Restricted' else 'Active' end",
    "overdraft_limit": "cast(case when (c_custkey + j) % 4 = 0 then (c_custkey * 13) % 5000 else 0 end as decimal(12,2))",
    "interest_rate": "cast(((c_custkey * 10 + j) * 17) % 4500 as decimal(12,3)) / 1000",
}

TRANSACTION_EXPRS = {
    "transaction_id": "cast(event_id as bigint)",
    # No account ends in 9: orphans.  Some rows have no customer; some customers always pay the same amount.
    "account_id": "cast(user_id * 10 + case when event_id % 157 = 0 then 9 else event_id % (1 + user_id % 3) end as bigint)",
    "customer_id": "cast(case when event_id % 331 = 0 then null else user_id end as bigint)",
    "transaction_date": "ts",
    "transaction_type": "case event_type when 'purchase' then 'POS Purchase' when 'click' then 'Online Payment' "
                        "when 'error' then 'ATM Withdrawal' when 'view' then 'Transfer' else 'Deposit' end",
    "amount": "cast(case when user_id % 53 = 0 then 19.99 when k = 0 then value * 20 else value end as decimal(12,2)) * "
              "(case when event_type in ('purchase', 'click', 'error') then -1 else 1 end)",
    "currency": "'USD'",
    "merchant_name": "case when event_id % 211 = 0 then null when k = 0 then case event_id % 5 "
                     "when 0 then 'International Casino' when 1 then 'Crypto Exchange' "
                     "when 2 then 'Offshore Merchant' when 3 then 'Unregistered Online Store' "
                     "else 'Foreign Travel Agency' end when event_id % 50 = 7 then concat(chr(9), ' Walmart ') "
                     "else case event_id % 5 when 0 then 'Amazon' when 1 then 'Netflix' when 2 then 'Uber' "
                     "when 3 then 'Costco' else 'Home Depot' end end",
    "merchant_category": "case when k = 0 then case event_id % 5 when 0 then 'Gambling' when 1 then 'Cryptocurrency' "
                         "else 'Other' end when event_id % 50 = 7 then 'Retail' else case event_id % 5 "
                         "when 0 then 'Online Retail' when 1 then 'Entertainment' when 2 then 'Transportation' "
                         "when 3 then 'Retail' else 'Other' end end",
    "merchant_location": "case when event_id % 199 = 0 then null else concat('City', cast(user_id % 50 as string), "
                         "', S', cast(event_id % 10 as string)) end",
    "transaction_channel": "case event_id % 5 when 0 then 'Branch' when 1 then 'ATM' when 2 then 'Online' "
                           "when 3 then 'Mobile' else 'POS Terminal' end",
    "device_id": "case when event_id % 10 < 3 then null else concat('dev', cast(user_id % 7 + event_id % 4 as string)) end",
    "ip_address": "case when event_id % 2 = 1 then null else concat('10.0.0.', cast(event_id % 250 as string)) end",
    "is_fraud": "k = 0",
    "status": "case event_id % 5 when 3 then 'Pending' when 4 then 'Failed' else 'Completed' end",
}
TRANSACTION_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

INTERACTION_EXPRS = {
    "interaction_id": "cast(o_orderkey as bigint)",
    "customer_id": "cast(o_custkey as bigint)",
    "interaction_type": "case o_orderpriority when '1-URGENT' then 'complaint' when '2-HIGH' then 'account_issue' "
                        "when '3-MEDIUM' then 'product_inquiry' else 'support_call' end",
    "channel": "case o_orderkey % 3 when 0 then 'Phone' when 1 then 'Email' else 'Chat' end",
    "date_time": "o_orderdate",
    "outcome": "case o_orderstatus when 'F' then 'Resolved' when 'O' then 'Pending' else 'Escalated' end",
    "satisfaction_score": "cast(case when o_orderkey % 10 < 3 then null else 1 + o_orderkey % 5 end as int)",
}

FRAUD_REPORT_EXPRS = {
    "report_id": "cast(o_orderkey as bigint)",
    "customer_id": "cast(o_custkey as bigint)",
    "report_date": "cast(o_orderdate as date)",
    "report_type": "case o_orderkey % 3 when 0 then 'Stolen Card' when 1 then 'Phishing' else 'Online Fraud' end",
    "status": "case o_orderstatus when 'F' then 'Closed' else 'Open' end",
    "amount_lost": "cast(case when o_orderkey % 3 = 0 then 0 else (o_orderkey * 7919) % 10000 end as decimal(12,2))",
    "recovery_amount": "cast(case when o_orderkey % 7 = 0 then o_orderkey % 5000 else 0 end as decimal(12,2))",
}


def _conform(df: DataFrame, exprs: dict[str, str], table: str) -> DataFrame:
    """Evaluate the mapping and cast to the raw contract; unmapped columns are NULL."""
    mapped = df.selectExpr(*[f"{e} AS {name}" for name, e in exprs.items()])
    return mapped.select(*[
        (F.col(f.name) if f.name in exprs else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RAW_SCHEMAS[table].fields
    ])


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_frames(spark: SparkSession, sf_dir: str) -> dict[str, object]:
    """The five bronze entities (without load lineage columns).

    Values are zero-argument builders, so a caller that needs one entity
    only reads the driver tables behind it.
    """
    def customers() -> DataFrame:
        customer, nation = _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "nation")
        # nation is a fixed 25-row dimension: broadcasting it is size-safe.
        joined = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
        return _conform(joined, CUSTOMER_EXPRS, "bronze_customers")

    def accounts() -> DataFrame:
        # Up to three accounts per customer: a generator, not a join.
        rows = (_read(spark, sf_dir, "customer")
                .withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c_custkey") % 3))))
        return _conform(rows, ACCOUNT_EXPRS, "bronze_accounts")

    def interactions() -> DataFrame:
        return _conform(_read(spark, sf_dir, "orders"), INTERACTION_EXPRS, "bronze_interactions")

    def fraud_reports() -> DataFrame:
        return _conform(_read(spark, sf_dir, "orders"), FRAUD_REPORT_EXPRS, "bronze_fraud_reports")

    def transactions() -> DataFrame:
        events = _read(spark, sf_dir, "events").withColumn("k", F.expr(TRANSACTION_K))
        return _conform(events, TRANSACTION_EXPRS, "bronze_transactions")

    return {
        "bronze_customers": customers,
        "bronze_interactions": interactions,
        "bronze_fraud_reports": fraud_reports,
        "bronze_accounts": accounts,
        "bronze_transactions": transactions,
    }
