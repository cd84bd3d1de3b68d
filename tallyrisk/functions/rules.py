"""Business rules: bin edges, tier thresholds, keyword classes, lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyrisk.functions.binning import cut
from tallyrisk.functions.text import contains_any

INF = float("inf")

# --- Fixed values (must equal the reference's for identical results) -------
AGE_BINS = ([0, 25, 35, 50, 65, 100], ["18-25", "26-35", "36-50", "51-65", "65+"])
INCOME_BINS = ([0, 30000, 60000, 100000, 150000, INF],
               ["Low", "Lower-Middle", "Middle", "Upper-Middle", "High"])
TENURE_BINS = ([0, 1, 3, 5, 10, INF],
               ["<1 year", "1-3 years", "3-5 years", "5-10 years", "10+ years"])
ACCOUNT_AGE_BINS = ([0, 30, 90, 365, 1095, INF],
                    ["<1 month", "1-3 months", "3-12 months", "1-3 years", "3+ years"])
INTEREST_BINS = ([0, 0.5, 1.5, 3.0, INF], ["Low", "Medium", "High", "Premium"])
HOUR_BINS = ([0, 6, 12, 17, 20, 24], ["Late Night", "Morning", "Afternoon", "Evening", "Night"])
AMOUNT_BINS = ([0, 50, 200, 1000, 10000], ["tiny", "small", "medium", "large"])
CREDIT_TIERS = [(800, "Excellent"), (740, "Very Good"), (670, "Good"), (580, "Fair")]
CREDIT_TIER_ELSE = "Poor"
RISK_TIERS = [(2.5, "HIGH"), (1.5, "MEDIUM")]
RISK_TIER_ELSE = "LOW"
ALERT_LEVELS = [(0.9, "CRITICAL"), (0.7, "HIGH"), (0.5, "MEDIUM")]
ALERT_LEVEL_ELSE = "LOW"
RISK_LEVEL_SCORES = {"Low": 1, "Medium": 2, "High": 3}
OCCUPATION_CLASSES = [
    ("Tech", ["engineer", "developer", "technician", "analyst"]),
    ("Healthcare", ["doctor", "nurse", "therapist", "health"]),
    ("Education", ["teacher", "professor", "instructor"]),
    ("Management", ["manager", "director", "executive"]),
    ("Sales/Marketing", ["sales", "marketing", "advertising"]),
]
OCCUPATION_ELSE = "Other"
HIGH_RISK_MERCHANT_WORDS = ["casino", "crypto", "offshore", "foreign", "unknown"]
HIGH_VALUE_BALANCE = 50000
# ---------------------------------------------------------------------------


def _threshold_chain(x: Column, steps, default: str, strict: bool = False) -> Column:
    expr = None
    for bound, label in steps:
        cond = (x > F.lit(bound)) if strict else (x >= F.lit(bound))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    # NULL input fails every comparison and falls to the default label.
    return expr.otherwise(F.lit(default))


def credit_tier(score: Column) -> Column:
    return _threshold_chain(score, CREDIT_TIERS, CREDIT_TIER_ELSE)


def fraud_risk_tier(score: Column) -> Column:
    return _threshold_chain(score, RISK_TIERS, RISK_TIER_ELSE)


def alert_level(prob: Column) -> Column:
    return _threshold_chain(prob, ALERT_LEVELS, ALERT_LEVEL_ELSE, strict=True)


def risk_level_score(level: Column) -> Column:
    """Low/Medium/High -> 1/2/3; anything else (NULL included) -> NULL."""
    expr = None
    for k, v in RISK_LEVEL_SCORES.items():
        cond = level == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(None)).cast("int")


def occupation_category(occupation: Column) -> Column:
    """First class whose keyword occurs in the lower-cased title; else Other."""
    low = F.lower(occupation)
    expr = None
    for label, words in OCCUPATION_CLASSES:
        cond = contains_any(low, words)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(OCCUPATION_ELSE))


def merchant_risk_level(merchant: Column) -> Column:
    return F.when(contains_any(F.lower(merchant), HIGH_RISK_MERCHANT_WORDS),
                  F.lit("High")).otherwise(F.lit("Low"))


def flag(cond: Column) -> Column:
    """Boolean where NULL counts as false (comparisons on missing values)."""
    return F.coalesce(cond, F.lit(False))


def bin_with(x: Column, spec, right: bool = True) -> Column:
    edges, labels = spec
    return cut(x, edges, labels, right=right)
