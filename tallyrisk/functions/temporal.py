"""Time helpers.  All timestamps are TIMESTAMP_NTZ; "now" is an explicit as_of."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_text(as_of) -> str:
    if isinstance(as_of, dt.datetime):
        return as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(as_of, dt.date):
        return as_of.strftime("%Y-%m-%d 00:00:00")
    return str(as_of)


def as_of_ts(as_of) -> Column:
    return F.lit(_as_text(as_of)).cast("timestamp_ntz")


def as_of_date(as_of) -> Column:
    return F.to_date(as_of_ts(as_of))


def midnight_days_ago(as_of, days: int) -> Column:
    """Midnight of the as_of day minus ``days`` (like CURRENT_DATE - n days)."""
    return F.date_sub(as_of_date(as_of), days).cast("timestamp_ntz")


def instant_days_ago(as_of, days: int) -> Column:
    """The as_of instant minus ``days`` (like CURRENT_TIMESTAMP - n days)."""
    return as_of_ts(as_of) - F.make_dt_interval(F.lit(days))


def elapsed_days_floor(later: Column, earlier: Column) -> Column:
    """Whole elapsed 24-hour periods (floor), not calendar days."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")


def age_years(as_of, birth: Column) -> Column:
    """floor(days / 365), the 365-day year of the contract."""
    return F.floor(F.datediff(as_of_date(as_of), birth) / F.lit(365)).cast("int")


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5  # Monday = 0


def is_night(hour: Column) -> Column:
    return (hour < 6) | (hour > 22)


def is_business_hours(hour: Column, weekend: Column) -> Column:
    return (hour >= 9) & (hour <= 17) & ~weekend


def time_of_day(ts: Column) -> Column:
    """Time part as text HH:mm:ss.SSSSSS (the TIME type is not enabled)."""
    return F.date_format(ts, "HH:mm:ss.SSSSSS")


def hour_angle(hour: Column, fn: str) -> Column:
    angle = F.lit(2 * math.pi) * hour / F.lit(24)
    return F.sin(angle) if fn == "sin" else F.cos(angle)
