"""DuckDB SQL text for the adapter views and the silver and gold tables.

Written independently of the Spark code: windows are plain whole-customer
windows here, which is the straightforward definition the Spark plan must
reproduce.  ``as_of`` is fixed at 2024-02-03 12:00:00.

Column names, thresholds, labels and keyword lists in these statements are
fixed values: they must equal the source system's for the same results.
"""

from __future__ import annotations

from tallyrisk.sources.fixtures import (
    ACCOUNT_EXPRS, CUSTOMER_EXPRS, FRAUD_REPORT_EXPRS,
    INTERACTION_EXPRS, TRANSACTION_EXPRS, TRANSACTION_K,
)

AS_OF = "TIMESTAMP '2024-02-03 12:00:00'"
AS_OF_DATE = "DATE '2024-02-03'"


def id_hash(multiplier: int) -> str:
    """Three rounds of multiply, add, modulo 2**31 - 1 over the transaction id, in 64 bits."""
    h = "transaction_id % 2147483647"
    for _ in range(3):
        h = f"(({h}) * {multiplier} + 12345) % 2147483647"
    return f"({h})"


def midnight_minus(days: int) -> str:
    return f"CAST({AS_OF_DATE} - INTERVAL {days} DAY AS TIMESTAMP)"


def instant_minus(days: int) -> str:
    return f"({AS_OF} - INTERVAL {days} DAY)"


def dec(expr: str, p: int, s: int) -> str:
    """double -> DECIMAL rounding half away from zero on the shortest decimal text."""
    return f"CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL({p},{s}))"


def avg_dec2(expr: str) -> str:
    """Exact average of a 2-decimal column rounded half away from zero to 2 places."""
    cents = f"CAST(sum(({expr}) * 100) AS HUGEINT)"
    n = "count(" + expr + ")"
    return (f"CAST(sign({cents}) * ((2 * abs({cents}) + {n}) // (2 * {n})) AS DECIMAL(38,0)) / 100")


def avg_exact(expr: str, scale: int = 4) -> str:
    """Exact average of a column with at most 2 decimals, rounded half away from zero."""
    f = 10 ** scale
    num = f"CAST(sum(({expr}) * {f}) AS HUGEINT)"
    n = f"count({expr})"
    return (f"CAST(sign({num}) * ((2 * abs({num}) + {n}) // (2 * {n})) AS DOUBLE) / {f}")


def _sel(exprs: dict[str, str], types: dict[str, str]) -> str:
    cols = []
    for name, t in types.items():
        e = exprs.get(name)
        cols.append(f"CAST({e} AS {t}) AS {name}" if e else f"CAST(NULL AS {t}) AS {name}")
    return ", ".join(cols)


CUST_T = {"customer_id": "BIGINT", "first_name": "VARCHAR", "last_name": "VARCHAR", "email": "VARCHAR",
          "phone": "VARCHAR", "address": "VARCHAR", "city": "VARCHAR", "state": "VARCHAR",
          "zip_code": "VARCHAR", "date_of_birth": "DATE", "occupation": "VARCHAR",
          "income": "DECIMAL(12,2)", "credit_score": "INT", "customer_since": "DATE",
          "account_manager": "VARCHAR", "segment": "VARCHAR", "risk_level": "VARCHAR",
          "kyc_status": "VARCHAR", "last_updated": "TIMESTAMP"}
INTER_T = {"interaction_id": "BIGINT", "customer_id": "BIGINT", "interaction_type": "VARCHAR",
           "channel": "VARCHAR", "agent_id": "BIGINT", "date_time": "TIMESTAMP", "duration_minutes": "INT",
           "notes": "VARCHAR", "outcome": "VARCHAR", "satisfaction_score": "INT"}
REPORT_T = {"report_id": "BIGINT", "customer_id": "BIGINT", "report_date": "DATE", "report_type": "VARCHAR",
            "description": "VARCHAR", "status": "VARCHAR", "amount_lost": "DECIMAL(12,2)",
            "recovery_amount": "DECIMAL(12,2)", "investigator": "VARCHAR", "notes": "VARCHAR"}
ACCT_T = {"account_id": "BIGINT", "customer_id": "BIGINT", "account_number": "VARCHAR", "account_type": "VARCHAR",
          "opening_date": "DATE", "current_balance": "DECIMAL(12,2)", "available_balance": "DECIMAL(12,2)",
          "currency": "VARCHAR", "status": "VARCHAR", "overdraft_limit": "DECIMAL(12,2)",
          "interest_rate": "DECIMAL(5,3)", "last_updated": "TIMESTAMP"}
TXN_T = {"transaction_id": "BIGINT", "account_id": "BIGINT", "customer_id": "BIGINT", "transaction_date": "TIMESTAMP",
         "transaction_type": "VARCHAR", "amount": "DECIMAL(12,2)", "currency": "VARCHAR",
         "merchant_name": "VARCHAR", "merchant_category": "VARCHAR", "merchant_location": "VARCHAR",
         "transaction_channel": "VARCHAR", "device_id": "VARCHAR", "ip_address": "VARCHAR",
         "is_fraud": "BOOLEAN", "status": "VARCHAR", "description": "VARCHAR"}

BRONZE = {
    "bronze_customers": f"SELECT {_sel(CUSTOMER_EXPRS, CUST_T)} FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey",
    "bronze_interactions": f"SELECT {_sel(INTERACTION_EXPRS, INTER_T)} FROM orders o",
    "bronze_fraud_reports": f"SELECT {_sel(FRAUD_REPORT_EXPRS, REPORT_T)} FROM orders o",
    "bronze_accounts": f"SELECT {_sel(ACCOUNT_EXPRS, ACCT_T)} FROM (SELECT *, unnest(generate_series(0, c_custkey % 3)) AS j FROM customer) c",
    "bronze_transactions": f"SELECT {_sel(TRANSACTION_EXPRS, TXN_T)} FROM (SELECT *, {TRANSACTION_K} AS k FROM events) e",
}

SILVER_CUSTOMERS = f"""
SELECT c.customer_id,
  c.first_name || ' ' || c.last_name AS full_name,
  c.email,
  regexp_replace(c.phone, '[^0-9]', '', 'g') AS phone_cleaned,
  c.state AS location_state, c.city AS location_city,
  c.age,
  CASE WHEN c.age > 0 AND c.age <= 25 THEN '18-25' WHEN c.age > 25 AND c.age <= 35 THEN '26-35'
       WHEN c.age > 35 AND c.age <= 50 THEN '36-50' WHEN c.age > 50 AND c.age <= 65 THEN '51-65'
       WHEN c.age > 65 AND c.age <= 100 THEN '65+' END AS age_group,
  CASE WHEN lower(c.occupation) SIMILAR TO '.*(engineer|developer|technician|analyst).*' THEN 'Tech'
       WHEN lower(c.occupation) SIMILAR TO '.*(doctor|nurse|therapist|health).*' THEN 'Healthcare'
       WHEN lower(c.occupation) SIMILAR TO '.*(teacher|professor|instructor).*' THEN 'Education'
       WHEN lower(c.occupation) SIMILAR TO '.*(manager|director|executive).*' THEN 'Management'
       WHEN lower(c.occupation) SIMILAR TO '.*(sales|marketing|advertising).*' THEN 'Sales/Marketing'
       ELSE 'Other' END AS occupation_category,
  CASE WHEN c.income > 0 AND c.income <= 30000 THEN 'Low' WHEN c.income > 30000 AND c.income <= 60000 THEN 'Lower-Middle'
       WHEN c.income > 60000 AND c.income <= 100000 THEN 'Middle' WHEN c.income > 100000 AND c.income <= 150000 THEN 'Upper-Middle'
       WHEN c.income > 150000 THEN 'High' END AS income_bucket,
  c.credit_score,
  CASE WHEN c.credit_score >= 800 THEN 'Excellent' WHEN c.credit_score >= 740 THEN 'Very Good'
       WHEN c.credit_score >= 670 THEN 'Good' WHEN c.credit_score >= 580 THEN 'Fair' ELSE 'Poor' END AS credit_score_tier,
  c.tenure AS customer_tenure_days,
  CASE WHEN c.tenure / 365.0 > 0 AND c.tenure / 365.0 <= 1 THEN '<1 year'
       WHEN c.tenure / 365.0 > 1 AND c.tenure / 365.0 <= 3 THEN '1-3 years'
       WHEN c.tenure / 365.0 > 3 AND c.tenure / 365.0 <= 5 THEN '3-5 years'
       WHEN c.tenure / 365.0 > 5 AND c.tenure / 365.0 <= 10 THEN '5-10 years'
       WHEN c.tenure / 365.0 > 10 THEN '10+ years' END AS tenure_group,
  c.segment,
  CAST(CASE c.risk_level WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 END AS INT) AS risk_score,
  CAST(NULL AS VARCHAR) AS risk_tier,
  coalesce(c.kyc_status = 'Verified', false) AS kyc_verified,
  CAST(coalesce(ac.n, 0) AS INT) AS total_accounts,
  CAST(coalesce(ac.total, 0) AS DECIMAL(12,2)) AS total_balance,
  CAST(coalesce(ac.mean, 0) AS DECIMAL(12,2)) AS avg_account_balance,
  CAST(it.last_dt AS DATE) AS last_interaction_date,
  CAST(coalesce(it.n, 0) AS INT) AS total_interactions,
  CAST(coalesce(it.complaints, 0) AS INT) AS complaint_count,
  coalesce(fr.n, 0) > 0 AS has_fraud_history,
  CAST(coalesce(fr.n, 0) AS INT) AS fraud_report_count,
  CAST(coalesce(fr.loss, 0) AS DECIMAL(12,2)) AS total_fraud_loss,
  {AS_OF} AS created_at, {AS_OF} AS updated_at,
  c.customer_id AS source_customer_id
FROM (SELECT *, CAST(floor(date_diff('day', date_of_birth, {AS_OF_DATE}) / 365.0) AS INT) AS age,
             CAST(date_diff('day', customer_since, {AS_OF_DATE}) AS INT) AS tenure
      FROM bronze_customers) c
LEFT JOIN (SELECT customer_id, max(date_time) AS last_dt, count(*) AS n,
                  sum(CASE WHEN interaction_type = 'complaint' THEN 1 ELSE 0 END) AS complaints
           FROM bronze_interactions GROUP BY customer_id) it ON it.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n, sum(amount_lost) AS loss
           FROM bronze_fraud_reports GROUP BY customer_id) fr ON fr.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n, sum(current_balance) AS total,
                  {avg_dec2('current_balance')} AS mean
           FROM bronze_accounts GROUP BY customer_id) ac ON ac.customer_id = c.customer_id
"""

SILVER_ACCOUNTS = f"""
SELECT a.account_id, a.customer_id,
  '****' || right(a.account_number, 4) AS account_number_masked,
  a.account_type, CAST(NULL AS VARCHAR) AS account_subtype, a.opening_date,
  a.age_days AS account_age_days,
  CASE WHEN a.age_days > 0 AND a.age_days <= 30 THEN '<1 month' WHEN a.age_days > 30 AND a.age_days <= 90 THEN '1-3 months'
       WHEN a.age_days > 90 AND a.age_days <= 365 THEN '3-12 months' WHEN a.age_days > 365 AND a.age_days <= 1095 THEN '1-3 years'
       WHEN a.age_days > 1095 THEN '3+ years' END AS age_group,
  CAST(t.last_ts AS DATE) AS last_activity_date,
  a.current_balance, a.available_balance,
  CAST(NULL AS DECIMAL(12,2)) AS average_balance_30d, CAST(NULL AS VARCHAR) AS balance_trend,
  coalesce(a.overdraft_limit > 0, false) AS has_overdraft,
  CASE WHEN coalesce(a.overdraft_limit > 0, false)
       THEN {dec("greatest(0, least(1, CAST(a.overdraft_limit - a.available_balance AS DOUBLE) / CAST(a.overdraft_limit AS DOUBLE)))", 5, 3)}
       ELSE CAST(0 AS DECIMAL(5,3)) END AS overdraft_utilization,
  CASE WHEN a.interest_rate > 0 AND a.interest_rate <= 0.5 THEN 'Low' WHEN a.interest_rate > 0.5 AND a.interest_rate <= 1.5 THEN 'Medium'
       WHEN a.interest_rate > 1.5 AND a.interest_rate <= 3.0 THEN 'High' WHEN a.interest_rate > 3.0 THEN 'Premium' END AS interest_rate_tier,
  a.status AS account_status,
  coalesce(a.status = 'Active', false) AS is_active,
  CAST(coalesce(t.mean_abs, 0) AS DECIMAL(10,2)) AS avg_daily_transactions,
  CAST(coalesce(t.n, 0) AS INT) AS total_transactions_30d,
  CAST(t.last_ts AS DATE) AS last_transaction_date,
  CAST(coalesce(floor(date_diff('microsecond', t.last_ts, {AS_OF}) / 86400000000.0), 999) AS INT) AS days_since_last_transaction,
  CAST(coalesce(f.n, 0) AS INT) AS fraud_transaction_count,
  CAST(coalesce(f.total, 0) AS DECIMAL(12,2)) AS fraud_amount_total,
  {AS_OF} AS created_at, {AS_OF} AS updated_at
FROM (SELECT *, CAST(date_diff('day', opening_date, {AS_OF_DATE}) AS INT) AS age_days FROM bronze_accounts) a
LEFT JOIN (SELECT account_id, count(*) AS n, max(transaction_date) AS last_ts, {avg_dec2('abs(amount)')} AS mean_abs
           FROM bronze_transactions WHERE transaction_date > {midnight_minus(30)} GROUP BY account_id) t
  ON t.account_id = a.account_id
LEFT JOIN (SELECT account_id, count(*) AS n, sum(abs(amount)) AS total
           FROM bronze_transactions WHERE is_fraud = true GROUP BY account_id) f ON f.account_id = a.account_id
"""

SILVER_TRANSACTIONS = f"""
SELECT t.transaction_id, t.account_id, t.customer_id,
  t.transaction_date AS transaction_timestamp,
  CAST(t.transaction_date AS DATE) AS transaction_date,
  strftime(t.transaction_date, '%H:%M:%S.%f') AS transaction_time,
  t.transaction_type, CAST(NULL AS VARCHAR) AS transaction_subtype,
  t.amount, abs(t.amount) AS amount_abs, t.currency, CAST(NULL AS VARCHAR) AS merchant_name,
  regexp_replace(t.merchant_name, '^\\s+|\\s+$', '', 'g') AS merchant_name_clean,
  t.merchant_category,
  CASE WHEN lower(t.merchant_name) SIMILAR TO '.*(casino|crypto|offshore|foreign|unknown).*' THEN 'High' ELSE 'Low' END AS merchant_risk_level,
  t.merchant_location,
  string_split(t.merchant_location, ', ')[-1] AS merchant_state,
  CAST(NULL AS VARCHAR) AS merchant_country,
  t.transaction_channel, t.device_id, t.ip_address,
  CAST(hour(t.transaction_date) AS INT) AS transaction_hour,
  CASE WHEN hour(t.transaction_date) < 6 THEN 'Late Night' WHEN hour(t.transaction_date) < 12 THEN 'Morning'
       WHEN hour(t.transaction_date) < 17 THEN 'Afternoon' WHEN hour(t.transaction_date) < 20 THEN 'Evening'
       ELSE 'Night' END AS hour_group,
  isodow(t.transaction_date) >= 6 AS is_weekend,
  hour(t.transaction_date) < 6 OR hour(t.transaction_date) > 22 AS is_night,
  CAST(NULL AS BOOLEAN) AS is_holiday,
  hour(t.transaction_date) >= 9 AND hour(t.transaction_date) <= 17 AND isodow(t.transaction_date) < 6 AS is_business_hours,
  c.age AS customer_age, c.risk_score AS customer_risk_score,
  a.current_balance AS account_balance,
  t.is_fraud, CAST(NULL AS VARCHAR) AS fraud_type, t.status AS transaction_status,
  {AS_OF} AS created_at
FROM bronze_transactions t
LEFT JOIN silver_customers c ON c.customer_id = t.customer_id
LEFT JOIN silver_accounts a ON a.account_id = t.account_id
"""

GOLD_CUSTOMER_360 = f"""
SELECT c.customer_id, c.full_name, c.segment AS demographic_segment, c.location_state AS location_tier,
  c.total_balance AS total_relationship_balance, c.avg_account_balance, c.credit_score_tier, c.income_bucket,
  CAST(coalesce(s.n, 0) AS INT) AS transaction_count_30d,
  CAST(coalesce(s.spent, 0) AS DECIMAL(12,2)) AS total_spent_30d,
  CAST(coalesce(s.mean_abs, 0) AS DECIMAL(10,2)) AS avg_transaction_value,
  c.risk_score AS overall_risk_score,
  c.tenure_group AS risk_tier,
  {dec("c.fraud_report_count / 10.0", 5, 4)} AS fraud_probability,
  c.last_interaction_date AS last_support_call,
  c.complaint_count AS complaint_count_90d,
  CAST(NULL AS DECIMAL(3,2)) AS satisfaction_score_avg,
  coalesce(c.total_balance > 50000, false) AS is_high_value,
  coalesce(c.risk_score >= 2 AND coalesce(f.n, 0) > 0, false) AS is_at_risk,
  NOT c.kyc_verified AS needs_kyc_review,
  {AS_OF_DATE} AS snapshot_date,
  {AS_OF} AS created_at
FROM silver_customers c
LEFT JOIN (SELECT customer_id, count(*) AS n,
                  sum(CASE WHEN amount < 0 THEN amount_abs ELSE 0 END) AS spent,
                  {avg_dec2('amount_abs')} AS mean_abs
           FROM silver_transactions WHERE transaction_timestamp > {midnight_minus(30)} GROUP BY customer_id) s
  ON s.customer_id = c.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS n FROM silver_transactions
           WHERE is_fraud = true AND transaction_timestamp > {midnight_minus(90)} GROUP BY customer_id) f
  ON f.customer_id = c.customer_id
"""

GOLD_FRAUD_FEATURES = f"""
SELECT transaction_id, customer_id, account_id, transaction_timestamp, amount,
  CASE WHEN amount_abs > 0 AND amount_abs <= 50 THEN 'tiny' WHEN amount_abs > 50 AND amount_abs <= 200 THEN 'small'
       WHEN amount_abs > 200 AND amount_abs <= 1000 THEN 'medium' WHEN amount_abs > 1000 AND amount_abs <= 10000 THEN 'large'
  END AS amount_category,
  customer_age, account_age_days AS customer_tenure_days, customer_risk_score,
  {dec("m / 30.0", 12, 2)} AS customer_avg_daily_spend,
  {dec("n / 30.0", 10, 2)} AS customer_transaction_frequency,
  account_age_days, account_balance,
  CAST(0 AS DECIMAL(12,2)) AS balance_change_24h, 0 AS account_transaction_count_7d,
  merchant_category,
  CAST(1 + {id_hash(40503)} % 9 AS INT) AS merchant_risk_score,
  rn_cat = 1 AS is_new_merchant_for_customer,
  transaction_hour, is_night AS is_night_time, is_weekend, false AS is_holiday,
  CAST(round(hours / 24.0) AS INT) AS days_since_last_transaction,
  {dec("sin(2 * pi() * transaction_hour / 24)", 10, 8)} AS hour_of_day_sin,
  {dec("cos(2 * pi() * transaction_hour / 24)", 10, 8)} AS hour_of_day_cos,
  0 AS transaction_count_1h, 0 AS transaction_count_24h, CAST(0 AS DECIMAL(12,2)) AS transaction_amount_24h,
  0 AS unique_merchants_24h, false AS is_new_device, false AS is_new_location,
  CAST({id_hash(30011)} % 10000 AS DECIMAL(18,2)) / 100 AS distance_from_home_km,
  CAST({id_hash(51787)} % 12000 AS DECIMAL(18,2)) / 100 AS velocity_kmh,
  {dec("CASE WHEN sd > 0 THEN (CAST(amount_abs AS DOUBLE) - m) / sd ELSE 0 END", 10, 4)} AS amount_z_score,
  {dec("hours / avg(hours) OVER (PARTITION BY customer_id)", 10, 2)} AS time_since_avg,
  {dec("CAST(amount_abs AS DOUBLE) - m", 12, 2)} AS amount_deviation_from_avg,
  is_fraud,
  CAST(CASE WHEN is_fraud THEN 1 ELSE 0 END AS DECIMAL(5,4)) AS fraud_probability,
  CASE WHEN customer_risk_score >= 2.5 THEN 'HIGH' WHEN customer_risk_score >= 1.5 THEN 'MEDIUM' ELSE 'LOW' END AS fraud_risk_tier,
  'v1.0' AS model_version, {AS_OF} AS prediction_timestamp, {AS_OF} AS created_at
FROM (
  SELECT *, coalesce(date_diff('microsecond', prev_ts, transaction_timestamp) / 3600000000.0, 24.0) AS hours
  FROM (
    SELECT t.*, a.account_age_days,
      CAST(sum(t.amount_abs) OVER (PARTITION BY t.customer_id) AS DOUBLE)
        / count(t.amount_abs) OVER (PARTITION BY t.customer_id) AS m,
      stddev_samp(CAST(t.amount_abs AS DOUBLE)) OVER (PARTITION BY t.customer_id) AS sd,
      count(t.amount_abs) OVER (PARTITION BY t.customer_id) AS n,
      lag(t.transaction_timestamp) OVER (PARTITION BY t.customer_id ORDER BY t.transaction_timestamp, t.transaction_id) AS prev_ts,
      row_number() OVER (PARTITION BY t.customer_id, t.merchant_category ORDER BY t.transaction_timestamp, t.transaction_id) AS rn_cat
    FROM silver_transactions t LEFT JOIN silver_accounts a ON a.account_id = t.account_id
    WHERE t.customer_id IS NOT NULL
  ) x
) y
"""

GOLD_DAILY = f"""
SELECT summary_date,
  CAST(total AS INT) AS total_transactions,
  CAST(frauds AS INT) AS fraudulent_transactions,
  {dec("frauds / total", 5, 4)} AS fraud_rate,
  CAST(amount AS DECIMAL(15,2)) AS total_amount,
  CAST(fraud_amount AS DECIMAL(15,2)) AS fraud_amount,
  CASE WHEN frauds > 0 THEN CAST(sign(fa_cents) * ((2 * abs(fa_cents) + frauds) // (2 * frauds)) AS DECIMAL(38,0)) / 100 END AS avg_fraud_amount,
  '{{}}' AS fraud_by_channel, '{{}}' AS fraud_by_merchant_category, '{{}}' AS fraud_by_hour,
  CAST(customers AS INT) AS affected_customers, 0 AS repeat_victims,
  CAST(frauds // 2 AS INT) AS auto_detected_count, CAST(frauds // 2 AS INT) AS reported_count,
  CAST(0 AS DECIMAL(10,2)) AS detection_lag_hours, {AS_OF} AS created_at, {AS_OF} AS updated_at
FROM (SELECT CAST(transaction_timestamp AS DATE) AS summary_date, count(*) AS total,
             sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS frauds, sum(amount_abs) AS amount,
             sum(CASE WHEN is_fraud THEN amount_abs ELSE 0 END) AS fraud_amount,
             CAST(sum(CASE WHEN is_fraud THEN amount_abs ELSE 0 END) * 100 AS HUGEINT) AS fa_cents,
             count(DISTINCT customer_id) AS customers
      FROM silver_transactions GROUP BY 1) d
"""

LAYERS = dict(BRONZE)
LAYERS.update({
    "silver_customers": SILVER_CUSTOMERS,
    "silver_accounts": SILVER_ACCOUNTS,
    "silver_transactions": SILVER_TRANSACTIONS,
    "gold_customer_360": GOLD_CUSTOMER_360,
    "gold_fraud_features": GOLD_FRAUD_FEATURES,
    "gold_daily_fraud_summary": GOLD_DAILY,
})
ORDER = list(LAYERS)


def with_layers(body: str, needs: list[str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (all layers by default, in order)."""
    names = ORDER if needs is None else [n for n in ORDER if n in _closure(needs)]
    ctes = ",\n".join(f"{n} AS ({LAYERS[n]})" for n in names)
    return f"WITH {ctes}\n{body}"


_DEPS = {
    "silver_customers": ["bronze_customers", "bronze_interactions", "bronze_fraud_reports", "bronze_accounts"],
    "silver_accounts": ["bronze_accounts", "bronze_transactions"],
    "silver_transactions": ["bronze_transactions", "silver_customers", "silver_accounts"],
    "gold_customer_360": ["silver_customers", "silver_transactions"],
    "gold_fraud_features": ["silver_transactions", "silver_accounts"],
    "gold_daily_fraud_summary": ["silver_transactions"],
}


def _closure(names: list[str]) -> set[str]:
    out: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in out:
            continue
        out.add(n)
        stack.extend(_DEPS.get(n, []))
    return out
