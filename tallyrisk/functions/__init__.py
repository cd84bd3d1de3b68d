"""Column expressions: binning, tiers, keyword classes, time and text helpers.

All helpers return native Spark ``Column`` expressions, so they stay inside
whole-stage code generation; no Python UDF is used anywhere.
"""

from tallyrisk.functions.binning import cut
from tallyrisk.functions.rules import (
    AGE_BINS, AMOUNT_BINS, HOUR_BINS, INCOME_BINS, INTEREST_BINS,
    ACCOUNT_AGE_BINS, TENURE_BINS, alert_level, credit_tier, fraud_risk_tier,
    merchant_risk_level, occupation_category, risk_level_score, flag,
)
from tallyrisk.functions.temporal import (
    as_of_ts, as_of_date, midnight_days_ago, instant_days_ago,
    elapsed_days_floor, age_years, is_weekend, is_night,
    is_business_hours, time_of_day, hour_angle,
)
from tallyrisk.functions.text import (
    full_name, digits_only, mask_tail, strip_ws, location_state, contains_any,
)

__all__ = [n for n in dir() if not n.startswith("_")]
