"""String helpers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when any word occurs as a substring; NULL text gives NULL."""
    cond = None
    for w in words:
        c = F.instr(text, w) > 0
        cond = c if cond is None else (cond | c)
    return cond


def full_name(first: Column, last: Column) -> Column:
    """first + ' ' + last; NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def mask_tail(text: Column, keep: int = 4, mask: str = "****") -> Column:
    return F.concat(F.lit(mask), F.right(text, F.lit(keep)))


def strip_ws(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs included)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def location_state(location: Column, sep: str = ", ") -> Column:
    """Last piece after ``sep``; the whole string if there is none; NULL stays NULL."""
    return F.element_at(F.split(location, re.escape(sep)), -1)


def email_address(first: Column, last: Column, domain: str = "example.com") -> Column:
    """S-08: lower(first).lower(last)@domain; NULL when either part is NULL."""
    return F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit(f"@{domain}"))


def place(city: Column, state: Column, sep: str = ", ") -> Column:
    """S-09: city and state; NULL when either part is NULL."""
    return F.concat(city, F.lit(sep), state)
