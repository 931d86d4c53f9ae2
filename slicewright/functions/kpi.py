"""Ratios and report KPIs (A-2, F-7, F-16, F-17)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of


def ratio(num, den) -> Column:
    """F-7 / A-2: ``num / den`` as a double; a zero or NULL denominator → NULL."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def percent(num, den) -> Column:
    """``num / den * 100``; zero denominator → NULL."""
    return ratio(num, den) * F.lit(100.0)


def fill_rate_percent(impressions="ad_server_impressions", requests="ad_requests") -> Column:
    """F-16: impressions per hundred ad requests."""
    return percent(impressions, requests)


def serve_rate_percent(code_serves="code_served_count", requests="ad_requests") -> Column:
    """F-17: code serves per hundred ad requests."""
    return percent(code_serves, requests)
