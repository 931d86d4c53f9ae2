"""Date functions (F-1, F-2, F-3, F-9, F-10, F-12).

All of them are native Spark expressions, so they stay inside whole-stage
codegen and can be used in predicates that Catalyst pushes to the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# Fixed value: month_year counts months from this base year.
MONTH_YEAR_BASE_YEAR = 2010


def _as_bigint(c: Column) -> Column:
    # Raw dimensions may arrive as text (paged results, CSV) or numbers.
    # A malformed date key is an error, as it is at the source: plain cast,
    # which raises under ANSI mode instead of silently giving NULL.
    return c.cast("bigint")


def month_year_to_date(c) -> Column:
    """F-1: ``(year-2010)*100 + month0`` → first day of that month.

    Floor semantics for negative values; a month part of 12 or more rolls the
    year over (1512 → 2026-01-01).
    """
    v = _as_bigint(col_of(c))
    m = F.pmod(v, F.lit(100))
    year_offset = (v - m).cast("bigint") / F.lit(100)  # exact: v - m is a multiple of 100
    year = F.lit(MONTH_YEAR_BASE_YEAR) + year_offset.cast("bigint") + F.floor(m / F.lit(12))
    month = F.pmod(m, F.lit(12)) + F.lit(1)
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def date_int_to_date(c) -> Column:
    """F-2: integer ``YYYYMMDD`` → DATE (an impossible date raises)."""
    v = _as_bigint(col_of(c))
    year = F.floor(v / F.lit(10000))
    month = F.floor(F.pmod(v, F.lit(10000)) / F.lit(100))
    day = F.pmod(v, F.lit(100))
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def iso_to_date(c) -> Column:
    """F-3: ISO text → DATE; a DATE or timestamp passes through as a date."""
    return F.to_date(col_of(c))


def date_to_int(c) -> Column:
    """Inverse of F-2, used to turn date bounds into raw-key predicates."""
    d = col_of(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def date_to_month_year(c) -> Column:
    """Inverse of F-1 (canonical form, month part 0..11)."""
    d = col_of(c)
    return ((F.year(d) - F.lit(MONTH_YEAR_BASE_YEAR)) * 100 + F.month(d) - 1).cast("bigint")


def first_of_month(c) -> Column:
    """F-9: first day of the month of ``c``."""
    return F.trunc(col_of(c), "MM")


def last_of_month(c) -> Column:
    """F-9: last day of the month of ``c``."""
    return F.last_day(col_of(c))


def first_of_previous_month(c) -> Column:
    """F-9: first day of the month before ``c``."""
    return F.trunc(F.add_months(col_of(c), -1), "MM")


def local_date(ts, tz: str) -> Column:
    """Calendar date of a UTC instant in time zone ``tz``."""
    return F.to_date(F.from_utc_timestamp(col_of(ts), tz))


def yesterday(ts=None, tz: str = "Europe/Paris") -> Column:
    """F-10: the day before today, today taken in ``tz`` (not the host clock)."""
    now = F.current_timestamp() if ts is None else col_of(ts)
    return F.date_sub(local_date(now, tz), 1)


def month_label(c) -> Column:
    """F-12: ``November 2025``."""
    return F.date_format(col_of(c), "MMMM yyyy")


def py_month_year(value: int) -> _dt.date:
    """Driver-side F-1 for parameters (dates given as month_year keys)."""
    m = value % 100
    return _dt.date(MONTH_YEAR_BASE_YEAR + value // 100 + m // 12, m % 12 + 1, 1)
