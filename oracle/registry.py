"""Registered queries: Spark builder + DuckDB SQL + comparison spec.

Every Spark builder reads the driver tables of ``sf_dir`` through the
bank-shaped fixtures, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle import compare, layers, tables
from tallyrisk.functions import text
from tallyrisk.plans.layers import all_layers
from tallyrisk.sources.fixtures import bronze_frames

AS_OF = "2024-02-03 12:00:00"  # the same instant as oracle.layers.AS_OF


@dataclass
class Query:
    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]   # layers -> result
    spec: str
    sql: str | None          # body selecting from the layer CTEs, or None
    needs: list[str] | None = None


REGISTRY: dict[str, Query] = {}
# Queries checked by row count only (no SQL equivalent); see README.
NO_ORACLE: set[str] = set()


def register(name: str, spec: str, sql: str | None, needs: list[str] | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, spec, sql, needs)
        return fn
    return deco


_LAYER_CACHE: dict[tuple[int, str], object] = {}


def spark_layers(spark: SparkSession, sf_dir: str):
    """Lazy layer tables over ``sf_dir``, shared by the queries of one session.

    Only the (immutable, unexecuted) plan objects are shared, so a session
    that runs many queries analyses each layer once; every query still
    executes in full from the Parquet files.
    """
    key = (id(spark._jsparkSession), sf_dir.rstrip("/"))
    if key not in _LAYER_CACHE:
        _LAYER_CACHE.clear()
        _LAYER_CACHE[key] = all_layers(bronze_frames(spark, sf_dir), AS_OF)
    return _LAYER_CACHE[key]


def run_spark(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    q = REGISTRY[name]
    return compare.spark_project(q.build(spark_layers(spark, sf_dir)), q.spec)


def oracle_text(name: str) -> str | None:
    q = REGISTRY[name]
    if q.sql is None:
        return None
    body = f"SELECT {compare.sql_project(q.spec)} FROM ({q.sql}) q"
    return layers.with_layers(body, q.needs)


# --- whole tables -----------------------------------------------------------

def _table(name: str, layer: str, spec: str):
    register(name, spec, f"SELECT * FROM {layer}", [layer])(lambda L: L[layer])


_table("H02_silver_customers", "silver_customers", tables.SILVER_CUSTOMERS)
_table("H03_silver_accounts", "silver_accounts", tables.SILVER_ACCOUNTS)
_table("H04_silver_transactions", "silver_transactions", tables.SILVER_TRANSACTIONS)
_table("H05_gold_customer_360", "gold_customer_360", tables.GOLD_CUSTOMER_360)
_table("H06_gold_fraud_features", "gold_fraud_features", tables.GOLD_FRAUD_FEATURES)
_table("H07_gold_daily_fraud_summary", "gold_daily_fraud_summary", tables.GOLD_DAILY)


# --- keyed aggregates --------------------------------------------------------
from tallyrisk.operators import aggregates as agg  # noqa: E402
from tallyrisk.operators import quality  # noqa: E402
from tallyrisk.plans import reports  # noqa: E402
from tallyrisk.schemas import BRONZE_TABLES, GOLD_TABLES, RAW_SCHEMAS, SILVER_TABLES  # noqa: E402
from oracle.layers import avg_exact, midnight_minus, instant_minus  # noqa: E402

register("D01_interaction_stats",
         "customer_id:i last_interaction_date:t total_interactions:i complaint_count:i",
         """SELECT customer_id, max(date_time) AS last_interaction_date, count(*) AS total_interactions,
                   sum(CASE WHEN interaction_type = 'complaint' THEN 1 ELSE 0 END) AS complaint_count
            FROM bronze_interactions GROUP BY customer_id""", ["bronze_interactions"],
         )(lambda L: agg.interaction_stats(L["bronze_interactions"]))

register("D02_fraud_report_stats", "customer_id:i fraud_report_count:i total_fraud_loss:n",
         """SELECT customer_id, count(*) AS fraud_report_count, sum(amount_lost) AS total_fraud_loss
            FROM bronze_fraud_reports GROUP BY customer_id""", ["bronze_fraud_reports"],
         )(lambda L: agg.fraud_report_stats(L["bronze_fraud_reports"]))

register("D03_account_txn_30d",
         "account_id:i total_transactions_30d:i last_transaction_ts:t avg_daily_transactions:n",
         f"""SELECT account_id, count(*) AS total_transactions_30d, max(transaction_date) AS last_transaction_ts,
                    {avg_exact('abs(amount)')} AS avg_daily_transactions
             FROM bronze_transactions WHERE transaction_date > {midnight_minus(30)} GROUP BY account_id""",
         ["bronze_transactions"])(lambda L: agg.account_txn_window(L["bronze_transactions"], AS_OF))

register("D04_account_fraud_totals", "account_id:i fraud_transaction_count:i fraud_amount_total:n",
         """SELECT account_id, count(*) AS fraud_transaction_count, sum(abs(amount)) AS fraud_amount_total
            FROM bronze_transactions WHERE is_fraud = true GROUP BY account_id""", ["bronze_transactions"],
         )(lambda L: agg.account_fraud_totals(L["bronze_transactions"]))

register("D05_customer_account_totals",
         "customer_id:i total_accounts:i total_balance:n avg_account_balance:n",
         f"""SELECT customer_id, count(*) AS total_accounts, sum(current_balance) AS total_balance,
                    {avg_exact('current_balance')} AS avg_account_balance
             FROM bronze_accounts GROUP BY customer_id""", ["bronze_accounts"],
         )(lambda L: agg.customer_account_totals(L["bronze_accounts"]))

register("D06_customer_spend_30d",
         "customer_id:i transaction_count_30d:i total_spent_30d:n avg_transaction_value:n last_transaction_date:t",
         f"""SELECT customer_id, count(*) AS transaction_count_30d,
                    sum(CASE WHEN amount < 0 THEN amount_abs ELSE 0 END) AS total_spent_30d,
                    {avg_exact('amount_abs')} AS avg_transaction_value,
                    max(transaction_timestamp) AS last_transaction_date
             FROM silver_transactions WHERE transaction_timestamp > {midnight_minus(30)} GROUP BY customer_id""",
         ["silver_transactions"])(lambda L: agg.customer_spend_window(L["transaction_basics"], AS_OF))

register("D07_customer_fraud_90d", "customer_id:i fraud_count_90d:i",
         f"""SELECT customer_id, count(*) AS fraud_count_90d FROM silver_transactions
             WHERE is_fraud = true AND transaction_timestamp > {midnight_minus(90)} GROUP BY customer_id""",
         ["silver_transactions"])(lambda L: agg.customer_fraud_window(L["transaction_basics"], AS_OF))

register("D08_daily_totals",
         "summary_date:d total_transactions:i fraudulent_transactions:i total_amount:n fraud_amount:n affected_customers:i",
         """SELECT CAST(transaction_timestamp AS DATE) AS summary_date, count(*) AS total_transactions,
                   sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS fraudulent_transactions,
                   sum(amount_abs) AS total_amount,
                   sum(CASE WHEN is_fraud THEN amount_abs ELSE 0 END) AS fraud_amount,
                   count(DISTINCT customer_id) AS affected_customers
            FROM silver_transactions GROUP BY 1""", ["silver_transactions"],
         )(lambda L: agg.daily_fraud_totals(L["transaction_basics"]))

# --- reports ------------------------------------------------------------------

# Definitions: an alert is a fraud of the last 7 days with its owner and masked account; its level is that of the
# highest threshold its probability exceeds.
_LEVELS = "(VALUES (0.9, 'CRITICAL'), (0.7, 'HIGH'), (0.5, 'MEDIUM')) l(threshold, name)"  # fixed values

register("H08_current_fraud_alerts",
         "transaction_id:i transaction_timestamp:t full_name:s account_number_masked:s amount:m "
         "merchant_category:s fraud_risk_tier:s fraud_probability:n alert_level:s",
         f"""SELECT f.*, c.full_name, a.account_number_masked,
                    coalesce((SELECT arg_max(l.name, l.threshold) FROM {_LEVELS} WHERE f.fraud_probability > l.threshold),
                             'LOW') AS alert_level
             FROM gold_fraud_features f
             JOIN gold_customer_360 c ON c.customer_id = f.customer_id
             JOIN silver_accounts a ON a.account_id = f.account_id
             WHERE f.is_fraud AND f.transaction_timestamp > {instant_minus(7)}""",
         ["gold_fraud_features", "gold_customer_360", "silver_accounts"],
         )(lambda L: reports.current_fraud_alerts(L.features(*reports.ALERT_FEATURES), L["gold_customer_360"],
                                                  L["silver_accounts"], AS_OF))

# Definition of the risk dashboard: a customer's accounts, frauds of the last 90 days and last activity in them.  The
# source counts every fraud once for each of the customer's account rows; "corrected" counts it once.
_DASH_SPEC = ("customer_id:i full_name:s demographic_segment:s total_relationship_balance:m "
              "overall_risk_score:i risk_tier:s fraud_probability:n account_count:i fraud_count_90d:i "
              "last_transaction_date:t")


def _dashboard_sql(factor: str) -> str:
    return f"""
        SELECT p.*, coalesce(own.accounts, 0) AS account_count,
               coalesce(act.frauds, 0) * {factor} AS fraud_count_90d, act.last_transaction_date
        FROM (SELECT customer_id, full_name, demographic_segment, total_relationship_balance, overall_risk_score,
                     risk_tier, fraud_probability FROM gold_customer_360) p
        LEFT JOIN (SELECT customer_id, count(*) AS account_rows, count(DISTINCT account_id) AS accounts
                   FROM silver_accounts GROUP BY customer_id) own USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(*) FILTER (is_fraud) AS frauds,
                          max(transaction_timestamp) AS last_transaction_date
                   FROM silver_transactions WHERE transaction_timestamp > {instant_minus(90)}
                   GROUP BY customer_id) act USING (customer_id)"""


for _name, _factor, _compat in (("H09_customer_risk_dashboard", "greatest(coalesce(own.account_rows, 0), 1)", True),
                                ("H09_customer_risk_dashboard_corrected", "1", False)):
    register(_name, _DASH_SPEC, _dashboard_sql(_factor), ["gold_customer_360", "silver_accounts", "silver_transactions"],
             )(lambda L, _c=_compat: reports.customer_risk_dashboard(
                 L["gold_customer_360"], L["silver_accounts"], L["transaction_basics"], AS_OF, compat=_c))

_START, _END = reports.default_window(AS_OF)

# Definition of a fraud rate: frauds per hundred rows.
_RATE = "100.0 * count(*) FILTER (is_fraud) / count(*)"
_RATE_COLUMNS = f"count(*) AS total, count(*) FILTER (is_fraud) AS fraud, {_RATE} AS fraud_rate"

register("D10_kpi_cards", "total_txns:i fraud_txns:i fraud_rate:n unique_customers:i",
         f"""SELECT k.total AS total_txns, k.fraud AS fraud_txns, k.fraud_rate, k.customers AS unique_customers
             FROM (SELECT {_RATE_COLUMNS}, count(DISTINCT customer_id) AS customers FROM gold_fraud_features
                   WHERE transaction_timestamp >= DATE '{_START}' AND transaction_timestamp < DATE '{_END}' + 1) k""",
         ["gold_fraud_features"],
         )(lambda L: reports.kpi_cards(L.features(*reports.RATE_FEATURES), _START, _END))

register("D11_fraud_by_hour", "transaction_hour:i total:i fraud:i fraud_rate:n",
         f"SELECT transaction_hour, {_RATE_COLUMNS} FROM gold_fraud_features GROUP BY ALL",
         ["gold_fraud_features"])(lambda L: reports.fraud_by_hour(L.features(*reports.RATE_FEATURES)))

register("D12_risky_merchant_categories", "merchant_category:s total:i fraud:i fraud_rate:n",
         f"""SELECT * EXCLUDE (place) FROM (
                 SELECT *, row_number() OVER (ORDER BY fraud_rate DESC, merchant_category NULLS LAST) AS place
                 FROM (SELECT merchant_category, {_RATE_COLUMNS} FROM gold_fraud_features GROUP BY ALL) c WHERE total > 10) r
             WHERE place <= 10""",
         ["gold_fraud_features"])(lambda L: reports.risky_merchant_categories(L.features(*reports.RATE_FEATURES)))

register("B19_daily_trend", "summary_date:d total_transactions:i fraudulent_transactions:i fraud_rate:n",
         """SELECT summary_date, total_transactions, fraudulent_transactions, fraud_rate
            FROM gold_daily_fraud_summary""", ["gold_daily_fraud_summary"],
         )(lambda L: reports.daily_trend(L["gold_daily_fraud_summary"]))

register("G05_recent_fraud_alerts",
         "transaction_id:i customer_id:i transaction_timestamp:t amount:n merchant_category:s "
         "fraud_risk_tier:s amount_z_score:n",
         """SELECT transaction_id, customer_id, transaction_timestamp, amount, merchant_category,
                   fraud_risk_tier, amount_z_score
            FROM gold_fraud_features WHERE is_fraud = true
            ORDER BY transaction_timestamp DESC, transaction_id DESC LIMIT 20""", ["gold_fraud_features"],
         )(lambda L: reports.recent_fraud_alerts_lazy(L.features(*reports.ALERT_FEATURES), L["transaction_basics"]))

# --- verification reports and quality checks ----------------------------------
from tallyrisk.plans import source_rules, verify  # noqa: E402
from tallyrisk.schemas import FOREIGN_KEYS, NULL_CHECKS, PRIMARY_KEYS, VARCHAR_LIMITS  # noqa: E402
from oracle import loads  # noqa: E402

# Distributions: rows of each group, means of the named columns.
def _mean(column: str) -> str:
    return f"sum(CAST({column} AS DOUBLE)) / nullif(count({column}), 0)"


register("D14_segment_by_risk", "segment:s risk_score:i customer_count:i avg_balance:n avg_credit_score:n",
         f"""SELECT segment, risk_score, count(customer_id) AS customer_count, {_mean('total_balance')} AS avg_balance,
                    {_mean('credit_score')} AS avg_credit_score FROM silver_customers GROUP BY ALL""", ["silver_customers"],
         )(lambda L: verify.segment_by_risk(L["silver_customers"]))

register("D15_account_type_distribution",
         "account_type:s account_count:i avg_balance:n active_count:i avg_age_years:n",
         f"""SELECT account_type, count(account_id) AS account_count, {_mean('current_balance')} AS avg_balance,
                    count(*) FILTER (is_active) AS active_count, {_mean('account_age_days')} / 365 AS avg_age_years
             FROM silver_accounts GROUP BY ALL""", ["silver_accounts"],
         )(lambda L: verify.account_type_distribution(L["silver_accounts"]))

register("D16_fraud_statistics", "is_fraud:b transaction_count:i avg_amount:n total_amount:m unique_customers:i",
         f"""SELECT g.*, c.unique_customers
             FROM (SELECT is_fraud, count(transaction_id) AS transaction_count, {_mean('amount_abs')} AS avg_amount,
                          sum(amount_abs) AS total_amount FROM silver_transactions GROUP BY ALL) g
             JOIN (SELECT is_fraud, count(customer_id) AS unique_customers
                   FROM (SELECT DISTINCT is_fraud, customer_id FROM silver_transactions) d GROUP BY ALL) c USING (is_fraud)""",
         ["silver_transactions"],
         )(lambda L: verify.fraud_statistics(L["transaction_basics"]))

register("D17_fraud_by_hour_group", "hour_group:s total_txns:i fraud_txns:i fraud_rate:n",
         f"""SELECT hour_group, r.total AS total_txns, r.fraud AS fraud_txns, round(r.fraud_rate, 2) AS fraud_rate
             FROM (SELECT hour_group, {_RATE_COLUMNS} FROM silver_transactions GROUP BY ALL) r""", ["silver_transactions"],
         )(lambda L: verify.fraud_by_hour_group(L["transaction_basics"]))

_LOADED = "\n".join(f"WHEN {n} THEN TIMESTAMP '{at}'" for n, at in enumerate(loads.LOAD_TIMES))
register("D18_batch_info", "batch_id:s earliest_load:t latest_load:t",
         f"""SELECT 'load_' || transaction_id % 2 AS batch_id, CASE transaction_id % 2 {_LOADED} END AS earliest_load,
                    CASE transaction_id % 2 {_LOADED} END AS latest_load
             FROM bronze_transactions GROUP BY transaction_id % 2""", ["bronze_transactions"],
         )(lambda L: verify.batch_info(loads.two_loads(L)))


def _counts_sql(names):
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in names)


for _key, _names in (("Q01_bronze_row_counts", BRONZE_TABLES), ("Q02_silver_row_counts", SILVER_TABLES),
                     ("Q03_gold_row_counts", GOLD_TABLES)):
    register(_key, "table_name:s row_count:i", _counts_sql(_names), list(_names),
             )(lambda L, _n=_names: quality.row_counts(L.lean(), list(_n)))

register("Q04_null_checks", "table_name:s column_name:s null_count:i status:s",
         " UNION ALL ".join(
             f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
                        CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN 'pass' ELSE 'warn' END AS status
                 FROM {t}""" for t, c in NULL_CHECKS),
         sorted({t for t, _ in NULL_CHECKS}))(lambda L: quality.null_checks(L))

register("Q05_duplicate_keys", "table_name:s key_columns:s duplicate_keys:i duplicate_rows:i",
         " UNION ALL ".join(
             f"""SELECT '{t}' AS table_name, '{",".join(k)}' AS key_columns, count(*) AS duplicate_keys,
                        coalesce(sum(n), 0) AS duplicate_rows
                 FROM (SELECT {", ".join(k)}, count(*) AS n FROM {t} GROUP BY {", ".join(k)} HAVING count(*) > 1) d"""
             for t, k in PRIMARY_KEYS.items()),
         list(PRIMARY_KEYS))(lambda L: quality.duplicate_keys(L.lean()))

register("Q06_foreign_key_orphans", "child_table:s child_column:s parent_table:s orphan_rows:i",
         " UNION ALL ".join(
             f"""SELECT '{c}' AS child_table, '{cc}' AS child_column, '{p}' AS parent_table, count(*) AS orphan_rows
                 FROM {c} WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)"""
             for c, cc, p, pc in FOREIGN_KEYS),
         sorted({x for c, _, p, _ in FOREIGN_KEYS for x in (c, p)}))(lambda L: quality.foreign_key_orphans(L.lean()))

register("Q07_fraud_count", "fraud_count:i",
         "SELECT count(*) AS fraud_count FROM bronze_transactions WHERE is_fraud = true", ["bronze_transactions"],
         )(lambda L: verify.fraud_count(L["bronze_transactions"]))

register("Q08_sample_customers", "customer_id:i first_name:s last_name:s income:n credit_score:i",
         """SELECT customer_id, first_name, last_name, income, credit_score FROM bronze_customers
            ORDER BY customer_id LIMIT 5""", ["bronze_customers"],
         )(lambda L: verify.sample(L["bronze_customers"],
                                   ["customer_id", "first_name", "last_name", "income", "credit_score"],
                                   "customer_id", 5))

register("Q09_sample_transactions", "transaction_id:i customer_id:i amount:n merchant_name:s is_fraud:b",
         """SELECT transaction_id, customer_id, amount, merchant_name, is_fraud FROM bronze_transactions
            ORDER BY transaction_id LIMIT 5""", ["bronze_transactions"],
         )(lambda L: verify.sample(L["bronze_transactions"],
                                   ["transaction_id", "customer_id", "amount", "merchant_name", "is_fraud"],
                                   "transaction_id", 5))

register("Q10_sample_customer_360",
         "customer_id:i full_name:s demographic_segment:s total_relationship_balance:n is_high_value:b",
         """SELECT customer_id, full_name, demographic_segment, total_relationship_balance, is_high_value
            FROM gold_customer_360 ORDER BY customer_id LIMIT 3""", ["gold_customer_360"],
         )(lambda L: verify.sample(L["gold_customer_360"],
                                   ["customer_id", "full_name", "demographic_segment",
                                    "total_relationship_balance", "is_high_value"], "customer_id", 3))

register("Q11_sample_fraud_features",
         "transaction_id:i customer_id:i amount:n merchant_category:s is_fraud:b fraud_risk_tier:s",
         """SELECT transaction_id, customer_id, amount, merchant_category, is_fraud, fraud_risk_tier
            FROM gold_fraud_features WHERE is_fraud = true ORDER BY transaction_id LIMIT 5""",
         ["gold_fraud_features"],
         )(lambda L: verify.sample(L.features("transaction_id", "customer_id", "amount", "merchant_category", "is_fraud",
                                              "fraud_risk_tier"),
                                   ["transaction_id", "customer_id", "amount", "merchant_category", "is_fraud",
                                    "fraud_risk_tier"], "transaction_id", 5, where="is_fraud"))

register("Q12_last_days", "summary_date:d total_transactions:i fraudulent_transactions:i fraud_rate:n",
         """SELECT summary_date, total_transactions, fraudulent_transactions, fraud_rate
            FROM gold_daily_fraud_summary ORDER BY summary_date DESC LIMIT 5""", ["gold_daily_fraud_summary"],
         )(lambda L: verify.last_days(L["gold_daily_fraud_summary"]))

register("Q13_length_checks", "table_name:s column_name:s max_length:i too_long:i",
         " UNION ALL ".join(
             f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_length,
                        count(*) FILTER (WHERE length({c}) > {n}) AS too_long FROM {t}"""
             for t, cols in VARCHAR_LIMITS.items() for c, n in cols.items()),
         list(VARCHAR_LIMITS))(lambda L: quality.length_violations(L))

# --- source-data rules ---------------------------------------------------------

register("B12_fraud_prone_customers", "customer_id:i",
         """SELECT customer_id FROM bronze_customers
            WHERE risk_level = 'High' OR segment IN ('Wealth', 'Corporate')""", ["bronze_customers"],
         )(lambda L: source_rules.fraud_prone_customers(L["bronze_customers"]))

register("D20_report_type_top3", "report_type:s report_count:i",
         """SELECT report_type, count(*) AS report_count FROM bronze_fraud_reports GROUP BY report_type
            ORDER BY report_count DESC, report_type ASC NULLS LAST LIMIT 3""", ["bronze_fraud_reports"],
         )(lambda L: source_rules.value_counts(L["bronze_fraud_reports"], "report_type", "report_count", 3))

register("D20_account_type_counts", "account_type:s account_count:i",
         """SELECT account_type, count(*) AS account_count FROM bronze_accounts GROUP BY account_type""",
         ["bronze_accounts"],
         )(lambda L: source_rules.value_counts(L["bronze_accounts"], "account_type", "account_count"))

register("D21_global_stats", "statistic:s value:n",
         """SELECT 'avg_amount_lost' AS statistic, avg(CAST(amount_lost AS DOUBLE)) AS value FROM bronze_fraud_reports
            UNION ALL SELECT 'avg_balance', avg(CAST(current_balance AS DOUBLE)) FROM bronze_accounts
            UNION ALL SELECT 'total_amount', CAST(sum(amount) AS DOUBLE) FROM bronze_transactions
            UNION ALL SELECT 'avg_abs_amount', avg(CAST(abs(amount) AS DOUBLE)) FROM bronze_transactions
            UNION ALL SELECT 'fraud_count', CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) FROM bronze_transactions
            UNION ALL SELECT 'fraud_rate', avg(CASE WHEN is_fraud THEN 1.0 ELSE 0.0 END) * 100 FROM bronze_transactions""",
         ["bronze_fraud_reports", "bronze_accounts", "bronze_transactions"],
         )(lambda L: source_rules.global_stats(L["bronze_fraud_reports"], L["bronze_accounts"],
                                               L["bronze_transactions"]))

# --- Fixed values (M13 the merchants' categories, M14 the types of debits): must equal the source system's ---
register("M13_merchant_category_lookup", "transaction_id:i merchant_name_clean:s lookup_category:s",
         """SELECT transaction_id, merchant_name_clean,
                   CASE merchant_name_clean WHEN 'Walmart' THEN 'Retail' WHEN 'Target' THEN 'Retail'
                        WHEN 'Costco' THEN 'Retail' WHEN 'Amazon' THEN 'Online Retail' WHEN 'Netflix' THEN 'Entertainment'
                        WHEN 'Starbucks' THEN 'Food & Beverage' WHEN 'Uber' THEN 'Transportation' WHEN 'Exxon' THEN 'Fuel'
                        WHEN 'Apple Store' THEN 'Electronics' WHEN 'International Casino' THEN 'Gambling'
                        WHEN 'Crypto Exchange' THEN 'Cryptocurrency' ELSE 'Other' END AS lookup_category
            FROM silver_transactions""", ["silver_transactions"],
         )(lambda L: source_rules.merchant_category_lookup(L["transaction_basics"].sparkSession,
                                                           L["transaction_basics"]))

register("M14_signed_amount", "transaction_id:i transaction_type:s signed_amount:n",
         """SELECT transaction_id, transaction_type,
                   CASE WHEN transaction_type IN ('ATM Withdrawal', 'POS Purchase', 'Online Payment', 'Bill Payment')
                        THEN -abs(amount) ELSE amount END AS signed_amount
            FROM bronze_transactions""", ["bronze_transactions"],
         )(lambda L: source_rules.signed_amount(L["bronze_transactions"]))

register("M16_clamp_credit_score", "customer_id:i clamped_score:i",
         "SELECT customer_id, greatest(300, least(850, credit_score)) AS clamped_score FROM bronze_customers",
         ["bronze_customers"])(lambda L: source_rules.clamp_credit_score(L["bronze_customers"]))

# --- real definitions of reserved columns -------------------------------------
from tallyrisk.operators import velocity  # noqa: E402
from oracle.layers import dec  # noqa: E402


def _rng(agg: str, part: str, width: str) -> str:
    return (f"CASE WHEN {part} IS NOT NULL THEN {agg} OVER (PARTITION BY {part} ORDER BY transaction_timestamp "
            f"RANGE BETWEEN INTERVAL {width} PRECEDING AND CURRENT ROW) END")


register("E08_E15_velocity_real",
         "transaction_id:i transaction_count_1h:i transaction_count_24h:i transaction_amount_24h:n "
         "unique_merchants_24h:i account_transaction_count_7d:i balance_change_24h:n is_new_device:b "
         "is_new_location:b",
         f"""SELECT transaction_id,
                    CAST({_rng('count(*)', 'customer_id', '1 HOUR')} AS INT) AS transaction_count_1h,
                    CAST({_rng('count(*)', 'customer_id', '24 HOUR')} AS INT) AS transaction_count_24h,
                    CAST({_rng('sum(amount_abs)', 'customer_id', '24 HOUR')} AS DECIMAL(12,2)) AS transaction_amount_24h,
                    CAST({_rng('count(DISTINCT merchant_name_clean)', 'customer_id', '24 HOUR')} AS INT) AS unique_merchants_24h,
                    CAST({_rng('count(*)', 'account_id', '7 DAY')} AS INT) AS account_transaction_count_7d,
                    CAST({_rng('sum(amount)', 'account_id', '24 HOUR')} AS DECIMAL(12,2)) AS balance_change_24h,
                    coalesce(customer_id IS NOT NULL AND row_number() OVER (PARTITION BY customer_id, device_id
                             ORDER BY transaction_timestamp, transaction_id) = 1, false) AS is_new_device,
                    coalesce(customer_id IS NOT NULL AND row_number() OVER (PARTITION BY customer_id, merchant_location
                             ORDER BY transaction_timestamp, transaction_id) = 1, false) AS is_new_location
             FROM silver_transactions""", ["silver_transactions"],
         )(lambda L: velocity.velocity_features(L["transaction_basics"]))

register("M23_merchant_risk_score_real",
         "merchant_category:s txn_count:i fraud_count:i fraud_rate:n merchant_risk_score:i",
         """SELECT merchant_category, txn_count, fraud_count, fraud_count / txn_count AS fraud_rate,
                   CAST(least(9, 1 + floor(fraud_count / txn_count * 9)) AS INT) AS merchant_risk_score
            FROM (SELECT merchant_category, count(*) AS txn_count, count(*) FILTER (WHERE is_fraud) AS fraud_count
                  FROM silver_transactions GROUP BY 1) g""", ["silver_transactions"],
         )(lambda L: velocity.merchant_category_risk(L["transaction_basics"]))

_JSON = """(SELECT d AS summary_date, '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}' AS {name}
            FROM (SELECT CAST(transaction_timestamp AS DATE) AS d, coalesce(CAST({col} AS VARCHAR), 'unknown') AS k,
                         count(*) AS n FROM silver_transactions WHERE is_fraud GROUP BY 1, 2) x GROUP BY d)"""

register("M24_E16_daily_breakdown_real",
         "summary_date:d fraud_by_channel:s fraud_by_merchant_category:s fraud_by_hour:s repeat_victims:i",
         f"""SELECT d.summary_date, coalesce(ch.fraud_by_channel, '{{}}') AS fraud_by_channel,
                    coalesce(mc.fraud_by_merchant_category, '{{}}') AS fraud_by_merchant_category,
                    coalesce(hr.fraud_by_hour, '{{}}') AS fraud_by_hour,
                    CAST(coalesce(rv.n, 0) AS INT) AS repeat_victims
             FROM (SELECT DISTINCT CAST(transaction_timestamp AS DATE) AS summary_date FROM silver_transactions) d
             LEFT JOIN {_JSON.format(name='fraud_by_channel', col='transaction_channel')} ch USING (summary_date)
             LEFT JOIN {_JSON.format(name='fraud_by_merchant_category', col='merchant_category')} mc USING (summary_date)
             LEFT JOIN {_JSON.format(name='fraud_by_hour', col='transaction_hour')} hr USING (summary_date)
             LEFT JOIN (SELECT v.d AS summary_date, count(*) AS n
                        FROM (SELECT DISTINCT customer_id, CAST(transaction_timestamp AS DATE) AS d
                              FROM silver_transactions WHERE is_fraud) v
                        JOIN (SELECT customer_id, min(CAST(transaction_timestamp AS DATE)) AS m
                              FROM silver_transactions WHERE is_fraud GROUP BY 1) f USING (customer_id)
                        WHERE v.d > f.m GROUP BY 1) rv USING (summary_date)""", ["silver_transactions"],
         )(lambda L: velocity.daily_breakdowns(L["transaction_basics"]))

register("M25_satisfaction_score_real", "customer_id:i satisfaction_score_avg:n",
         f"""SELECT customer_id, {dec('avg(CAST(satisfaction_score AS DOUBLE))', 3, 2)} AS satisfaction_score_avg
             FROM bronze_interactions GROUP BY customer_id""", ["bronze_interactions"],
         )(lambda L: velocity.satisfaction_average(L["bronze_interactions"]))

# A holiday calendar is a user input; the check uses the US federal holidays of early 2024.
# --- Fixed values ---
HOLIDAYS = ["2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-07-04"]

register("T14_is_holiday_real", "transaction_id:i is_holiday:b",
         f"""SELECT transaction_id, CAST(transaction_timestamp AS DATE) IN ({", ".join(f"DATE '{d}'" for d in HOLIDAYS)})
                    AS is_holiday FROM silver_transactions""", ["silver_transactions"],
         )(lambda L: velocity.holiday_flags(
             L["transaction_basics"],
             L["transaction_basics"].sparkSession.createDataFrame([(d,) for d in HOLIDAYS], "holiday_date string")))

register("D08_daily_fraud_victims_corrected", "summary_date:d fraud_victims:i",
         """SELECT CAST(transaction_timestamp AS DATE) AS summary_date,
                   count(DISTINCT CASE WHEN is_fraud THEN customer_id END) AS fraud_victims
            FROM silver_transactions GROUP BY 1""", ["silver_transactions"],
         )(lambda L: agg.daily_fraud_victims(L["transaction_basics"]))

# --- loads and layer runs over files written from the given tables --------------

register("S08_email_address", "customer_id:i email_address:s",
         """SELECT customer_id, lower(first_name) || '.' || lower(last_name) || '@example.com' AS email_address
            FROM bronze_customers""", ["bronze_customers"],
         )(lambda L: L["bronze_customers"].select(
             "customer_id", text.email_address(F.col("first_name"), F.col("last_name")).alias("email_address")))

register("S09_place", "customer_id:i place:s",
         "SELECT customer_id, city || ', ' || state AS place FROM bronze_customers", ["bronze_customers"],
         )(lambda L: L["bronze_customers"].select("customer_id", text.place(F.col("city"), F.col("state")).alias("place")))

register("A01_csv_round_trip", "interaction_id:i customer_id:i date_time:t notes:s satisfaction_score:i",
         f"""SELECT interaction_id, customer_id, date_time, {loads.NOTES_SQL} AS notes, satisfaction_score
             FROM bronze_interactions WHERE interaction_id % 17 <> 0""", ["bronze_interactions"],
         )(lambda L: loads.csv_round_trip(L))

register("A01_csv_rejects", "interaction_id:s reason:s",
         """SELECT CAST(interaction_id AS VARCHAR) AS interaction_id, 'satisfaction_score: not int' AS reason
            FROM bronze_interactions WHERE interaction_id % 17 = 0""", ["bronze_interactions"],
         )(lambda L: loads.csv_rejects(L))

register("A05_append_skip", "outcome:s row_count:i",
         """SELECT 'stored' AS outcome, count(*) AS row_count FROM bronze_transactions
            UNION ALL SELECT 'stored key', count(*) FROM bronze_transactions WHERE transaction_id % 3 = 0
            UNION ALL SELECT 'repeated key', count(*) FROM bronze_transactions WHERE transaction_id % 3 = 1
            UNION ALL SELECT 'missing key', count(*) FROM bronze_transactions WHERE transaction_id % 3 = 2""",
         ["bronze_transactions"])(lambda L: loads.append_skip(L))

register("A05_replay", "outcome:s transaction_id:i row_count:i",
         """SELECT 'stored' AS outcome, transaction_id, 1 AS row_count FROM bronze_transactions
            UNION ALL SELECT 'stored key', transaction_id, 1 FROM bronze_transactions WHERE transaction_id % 3 = 0
            UNION ALL SELECT 'repeated key', transaction_id, 1 FROM bronze_transactions WHERE transaction_id % 3 = 1
            UNION ALL SELECT 'missing key', NULL, count(*) FROM bronze_transactions WHERE transaction_id % 3 = 2""",
         ["bronze_transactions"])(lambda L: loads.append_replay(L))

register("H01_bronze_counts", "table_name:s row_count:i", _counts_sql(BRONZE_TABLES), list(BRONZE_TABLES),
         )(lambda L: loads.bronze_counts(L))

register("H10_silver_run_counts", "table_name:s row_count:i", _counts_sql(SILVER_TABLES), list(SILVER_TABLES),
         )(lambda L: loads.silver_counts(L, AS_OF))

register("H11_rejected_rows", "transaction_id:i account_id:i transaction_timestamp:t amount:n reject_reason:s",
         """SELECT transaction_id, account_id, transaction_timestamp, amount, 'no customer' AS reject_reason
            FROM silver_transactions WHERE customer_id IS NULL""", ["silver_transactions"],
         )(lambda L: loads.gold_rejects(L, AS_OF))

register("H12_dashboard_pack", "report:s row_count:i",
         f"""SELECT 'kpi_cards' AS report, 1 AS row_count
             UNION ALL SELECT 'fraud_by_hour', count(DISTINCT transaction_hour) FROM gold_fraud_features
             UNION ALL SELECT 'risky_merchant_categories', least(10, count(*)) FROM
                 (SELECT merchant_category FROM gold_fraud_features GROUP BY 1 HAVING count(*) > 10) m
             UNION ALL SELECT 'daily_trend', count(*) FROM gold_daily_fraud_summary
             UNION ALL SELECT 'recent_fraud_alerts', least(20, count(*)) FROM gold_fraud_features WHERE is_fraud""",
         ["gold_fraud_features", "gold_daily_fraud_summary"])(lambda L: loads.dashboard_counts(L, AS_OF))


# --- what whole runs stored, all columns -------------------------------------

def _bronze_spec(table: str) -> str:
    kinds = {"bigint": "i", "int": "i", "string": "s", "boolean": "b", "date": "d", "timestamp_ntz": "t", "double": "n"}
    return " ".join(f"{f.name}:{kinds.get(f.dataType.simpleString(), 'm')}" for f in RAW_SCHEMAS[table].fields)


for _t in BRONZE_TABLES:
    register(f"H01_stored_{_t}", _bronze_spec(_t), f"SELECT * FROM {_t}", [_t],
             )(lambda L, t=_t: loads.stored_bronze(L, AS_OF, t))

for _n, _t, _spec in (("H10", "silver_customers", tables.SILVER_CUSTOMERS), ("H10", "silver_accounts", tables.SILVER_ACCOUNTS),
                      ("H10", "silver_transactions", tables.SILVER_TRANSACTIONS),
                      ("H11", "gold_customer_360", tables.GOLD_CUSTOMER_360),
                      ("H11", "gold_fraud_features", tables.GOLD_FRAUD_FEATURES),
                      ("H11", "gold_daily_fraud_summary", tables.GOLD_DAILY)):
    register(f"{_n}_stored_{_t}", _spec, f"SELECT * FROM {_t}", [_t])(lambda L, t=_t: loads.stored_table(L, AS_OF, t))

register("C07_observed_counts", "table_name:s fact:s value:i",
         f"""SELECT 'silver_customers' AS table_name, 'matched_rows' AS fact, count(*) AS value
             FROM bronze_customers c WHERE EXISTS (SELECT 1 FROM bronze_accounts a WHERE a.customer_id = c.customer_id)
             UNION ALL SELECT table_name, 'rows', row_count FROM ({_counts_sql(SILVER_TABLES + GOLD_TABLES)}) n""",
         ["bronze_customers", "bronze_accounts", *SILVER_TABLES, *GOLD_TABLES],
         )(lambda L: loads.observed_counts(L, AS_OF))


def _measures(report: str, source: str) -> str:
    """A row a measure of a report's rows."""
    item, measures = loads.REPORT_COLUMNS[report]
    item = "''" if item is None else f"CAST({item} AS VARCHAR)"
    return " UNION ALL ".join(f"SELECT '{report}' AS report, {item} AS item, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM {source}"
                              for m in measures)


register("H12_dashboard_contents", "report:s item:s measure:s value:n",
         "WITH " + ", ".join(f"{report} AS ({REGISTRY[key].sql})" for report, key in (
             ("kpi_cards", "D10_kpi_cards"), ("fraud_by_hour", "D11_fraud_by_hour"),
             ("risky_merchant_categories", "D12_risky_merchant_categories"), ("daily_trend", "B19_daily_trend"),
             ("recent_fraud_alerts", "G05_recent_fraud_alerts")))
         + " " + " UNION ALL ".join(_measures(r, r) for r in loads.REPORT_COLUMNS),
         ["gold_fraud_features", "gold_daily_fraud_summary"])(lambda L: loads.dashboard_contents(L, AS_OF))

register("A09_kept_result", "merchant_category:s total:i fraud:i",
         """SELECT merchant_category, count(*) AS total, count(*) FILTER (is_fraud) AS fraud FROM gold_fraud_features
            WHERE transaction_timestamp >= TIMESTAMP '2023-07-01' GROUP BY ALL""",
         ["gold_fraud_features"])(lambda L: loads.kept_result(L, AS_OF))
