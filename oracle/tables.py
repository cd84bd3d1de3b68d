"""Comparison specs of the layer tables: all columns, the stamps (as_of) and hashed placeholders included."""

SILVER_CUSTOMERS = (
    "customer_id:i full_name:s email:s phone_cleaned:s location_state:s location_city:s age:i "
    "age_group:s occupation_category:s income_bucket:s credit_score:i credit_score_tier:s "
    "customer_tenure_days:i tenure_group:s segment:s risk_score:i risk_tier:s kyc_verified:b "
    "total_accounts:i total_balance:m avg_account_balance:m last_interaction_date:d "
    "total_interactions:i complaint_count:i has_fraud_history:b fraud_report_count:i "
    "total_fraud_loss:m created_at:t updated_at:t source_customer_id:i")

SILVER_ACCOUNTS = (
    "account_id:i customer_id:i account_number_masked:s account_type:s account_subtype:s "
    "opening_date:d account_age_days:i age_group:s last_activity_date:d current_balance:m "
    "available_balance:m average_balance_30d:n balance_trend:s has_overdraft:b "
    "overdraft_utilization:n interest_rate_tier:s account_status:s is_active:b "
    "avg_daily_transactions:n total_transactions_30d:i last_transaction_date:d "
    "days_since_last_transaction:i fraud_transaction_count:i fraud_amount_total:m created_at:t updated_at:t")

SILVER_TRANSACTIONS = (
    "transaction_id:i account_id:i customer_id:i transaction_timestamp:t transaction_date:d "
    "transaction_time:s transaction_type:s transaction_subtype:s amount:m amount_abs:m currency:s "
    "merchant_name:s merchant_name_clean:s merchant_category:s merchant_risk_level:s "
    "merchant_location:s merchant_state:s merchant_country:s transaction_channel:s device_id:s "
    "ip_address:s transaction_hour:i hour_group:s is_weekend:b is_night:b is_holiday:b "
    "is_business_hours:b customer_age:i customer_risk_score:i account_balance:m is_fraud:b "
    "fraud_type:s transaction_status:s created_at:t")

GOLD_CUSTOMER_360 = (
    "customer_id:i full_name:s demographic_segment:s location_tier:s total_relationship_balance:m "
    "avg_account_balance:m credit_score_tier:s income_bucket:s transaction_count_30d:i "
    "total_spent_30d:m avg_transaction_value:m overall_risk_score:i risk_tier:s fraud_probability:n "
    "last_support_call:d complaint_count_90d:i satisfaction_score_avg:n is_high_value:b "
    "is_at_risk:b needs_kyc_review:b snapshot_date:d created_at:t")

GOLD_FRAUD_FEATURES = (
    "transaction_id:i customer_id:i account_id:i transaction_timestamp:t amount:m amount_category:s "
    "customer_age:i customer_tenure_days:i customer_risk_score:i customer_avg_daily_spend:m "
    "customer_transaction_frequency:n account_age_days:i account_balance:m balance_change_24h:m "
    "account_transaction_count_7d:i merchant_category:s merchant_risk_score:i is_new_merchant_for_customer:b "
    "transaction_hour:i is_night_time:b is_weekend:b is_holiday:b days_since_last_transaction:i "
    "hour_of_day_sin:n8 hour_of_day_cos:n8 transaction_count_1h:i transaction_count_24h:i "
    "transaction_amount_24h:m unique_merchants_24h:i is_new_device:b is_new_location:b "
    "distance_from_home_km:m velocity_kmh:m amount_z_score:n time_since_avg:n amount_deviation_from_avg:m is_fraud:b fraud_probability:n "
    "fraud_risk_tier:s model_version:s prediction_timestamp:t created_at:t")

GOLD_DAILY = (
    "summary_date:d total_transactions:i fraudulent_transactions:i fraud_rate:n total_amount:m "
    "fraud_amount:m avg_fraud_amount:m fraud_by_channel:s fraud_by_merchant_category:s "
    "fraud_by_hour:s affected_customers:i repeat_victims:i auto_detected_count:i reported_count:i "
    "detection_lag_hours:n created_at:t updated_at:t")
