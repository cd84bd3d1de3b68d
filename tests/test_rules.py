"""Column rules and their edge cases (binning edges, NULL handling, text)."""

import datetime as dt

from pyspark.sql import functions as F

from tallyrisk.functions import rules, temporal, text
from tallyrisk.functions.rules import bin_with


def _one_col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_right_closed_bins(spark):
    df = _one_col(spark, [0.0, 0.5, 25.0, 26.0, 100.0, 101.0, None], "double")
    got = [r[0] for r in df.select(bin_with(F.col("x"), rules.AGE_BINS)).collect()]
    assert got == [None, "18-25", "18-25", "26-35", "65+", None, None]


def test_left_closed_hours(spark):
    df = _one_col(spark, [0, 5, 6, 12, 17, 20, 23], "int")
    got = [r[0] for r in df.select(bin_with(F.col("x"), rules.HOUR_BINS, right=False)).collect()]
    assert got == ["Late Night", "Late Night", "Morning", "Afternoon", "Evening", "Night", "Night"]


def test_opened_today_has_no_group(spark):
    df = _one_col(spark, [0, 1, 30, 31], "int")
    got = [r[0] for r in df.select(bin_with(F.col("x"), rules.ACCOUNT_AGE_BINS)).collect()]
    assert got == [None, "<1 month", "<1 month", "1-3 months"]


def test_null_rules(spark):
    df = spark.createDataFrame([(None, None, None, None)], "kyc string, credit int, risk double, level string")
    r = df.select(
        F.col("kyc").eqNullSafe("Verified").alias("kyc"),
        rules.credit_tier(F.col("credit")).alias("credit"),
        rules.fraud_risk_tier(F.col("risk")).alias("risk"),
        rules.risk_level_score(F.col("level")).alias("level"),
        rules.occupation_category(F.col("level")).alias("occ"),
        rules.merchant_risk_level(F.col("level")).alias("merchant"),
    ).first()
    assert (r.kyc, r.credit, r.risk, r.level, r.occ, r.merchant) == (False, "Poor", "LOW", None, "Other", "Low")


def test_tiers(spark):
    df = _one_col(spark, [850, 800, 799, 740, 670, 580, 579], "int")
    got = [r[0] for r in df.select(rules.credit_tier(F.col("x"))).collect()]
    assert got == ["Excellent", "Excellent", "Very Good", "Very Good", "Good", "Fair", "Poor"]
    df = _one_col(spark, [1.0, 0.95, 0.9, 0.71, 0.5, 0.0], "double")
    got = [r[0] for r in df.select(rules.alert_level(F.col("x"))).collect()]
    assert got == ["CRITICAL", "CRITICAL", "HIGH", "HIGH", "LOW", "LOW"]


def test_occupation_first_match_wins(spark):
    df = _one_col(spark, ["Sales engineer", "Sales executive", "Nurse", "Teacher", "Painter",
                          "HEALTH visitor"], "string")
    got = [r[0] for r in df.select(rules.occupation_category(F.col("x"))).collect()]
    assert got == ["Tech", "Management", "Healthcare", "Education", "Other", "Healthcare"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("\t Walmart \n", "City1, S3", "+1 (555) 0000042", "ACCT0000000123", "A", "B")],
                               "m string, loc string, phone string, acct string, f string, l string")
    r = df.select(text.strip_ws(F.col("m")).alias("m"), text.location_state(F.col("loc")).alias("s"),
                  text.digits_only(F.col("phone")).alias("p"), text.mask_tail(F.col("acct")).alias("a"),
                  text.full_name(F.col("f"), F.lit(None).cast("string")).alias("n")).first()
    assert (r.m, r.s, r.p, r.a, r.n) == ("Walmart", "S3", "15550000042", "****0123", None)
    df = _one_col(spark, [None, "Lagos"], "string")
    assert [r[0] for r in df.select(text.location_state(F.col("x"))).collect()] == [None, "Lagos"]


def test_elapsed_days_not_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 3, 12), dt.datetime(2024, 1, 1, 18))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(temporal.elapsed_days_floor(F.col("a"), F.col("b")).alias("e"),
                  F.datediff(F.col("a"), F.col("b")).alias("c")).first()
    assert (r.e, r.c) == (1, 2)


def test_weekend_and_age(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 10), dt.date(2000, 2, 4))], "ts timestamp_ntz, dob date")
    r = df.select(temporal.is_weekend(F.col("ts")).alias("w"),
                  temporal.age_years("2024-02-03 12:00:00", F.col("dob")).alias("age")).first()
    # 8765 days: 24 years of 365 days, though the calendar age is 23
    assert r.w is True and r.age == 24


def test_overdraft_utilisation_null_inputs(spark):
    from tallyrisk.plans.silver import silver_accounts
    from tallyrisk.schemas import RAW_SCHEMAS
    acc = spark.createDataFrame(
        [(1, 1, "ACCT1", "Checking", dt.date(2020, 1, 1), 10, None, "USD", "Active", 100, 1.0, None),
         (2, 1, "ACCT2", "Checking", dt.date(2020, 1, 1), 10, 150, "USD", "Active", 100, 1.0, None),
         (3, 1, "ACCT3", "Checking", dt.date(2020, 1, 1), 10, 50, "USD", "Active", 100, 1.0, None),
         (4, 1, "ACCT4", "Savings", dt.date(2020, 1, 1), 10, 50, "USD", None, None, 1.0, None)],
        "account_id int, customer_id int, account_number string, account_type string, opening_date date, "
        "current_balance int, available_balance int, currency string, status string, overdraft_limit int, "
        "interest_rate double, last_updated timestamp_ntz")
    acc = acc.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMAS["bronze_accounts"].fields])
    txn = spark.createDataFrame([], RAW_SCHEMAS["bronze_transactions"])
    rows = {r.account_id: r for r in silver_accounts(acc, txn, "2024-02-03 12:00:00").collect()}
    assert rows[1].overdraft_utilization is None
    assert float(rows[2].overdraft_utilization) == 0.0
    assert float(rows[3].overdraft_utilization) == 0.5
    assert float(rows[4].overdraft_utilization) == 0.0 and rows[4].is_active is False
    assert rows[4].days_since_last_transaction == 999 and rows[4].total_transactions_30d == 0
