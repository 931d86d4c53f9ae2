"""Properties: typing round trips, month chunks, dedupe invariants."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slicewright import registry
from slicewright.functions import date_int_to_date, date_to_int, date_to_month_year, month_year_to_date
from slicewright.functions.dates import py_month_year
from slicewright.operators import audit, calendar
from slicewright.plans import reports

from .conftest import SF01


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(min_value=-1500, max_value=3000), min_size=1, max_size=60))
def test_month_year_matches_python_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in df.select(month_year_to_date("v")).collect()]
    assert got == [py_month_year(v) for v in values]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2200, 12, 31)), min_size=1, max_size=60))
def test_date_keys_round_trip(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(date_int_to_date(date_to_int("d")).alias("a"),
                    month_year_to_date(date_to_month_year("d")).alias("b")).collect()
    assert [r.a for r in got] == days
    assert [r.b for r in got] == [d.replace(day=1) for d in days]


@settings(max_examples=3, deadline=None)
@given(st.dates(min_value=dt.date(2000, 1, 1), max_value=dt.date(2030, 1, 1)), st.integers(0, 400))
def test_month_ranges_cover_each_day_once(spark, start, span):
    end = start + dt.timedelta(days=span)
    chunks = calendar.month_ranges(spark, start, end).orderBy("chunk").collect()
    days = []
    for c in chunks:
        assert c.month_start.replace(day=1) == c.month_end.replace(day=1)
        days += [c.month_start + dt.timedelta(days=i) for i in range((c.month_end - c.month_start).days + 1)]
    assert days == [start + dt.timedelta(days=i) for i in range(span + 1)]
    assert [c.chunk for c in chunks] == list(range(1, len(chunks) + 1))


def test_dedupe_keeps_daily_sums_and_removes_duplicates(spark):
    from slicewright.sources import fixtures

    raw = fixtures.raw_report(spark, SF01, "fill_rate")
    typed = reports.transform(raw, registry.REPORTS["fill_rate"])
    deduped = reports.report_fill_rate(raw)
    metrics = list(registry.FILL_RATE_SUM_COLUMNS)
    a = typed.groupBy("date").agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in metrics])
    b = deduped.groupBy("date").agg(*[F.sum(m).alias(m) for m in metrics])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert audit.audit_duplicates(deduped, registry.DUPLICATE_KEYS["fill_rate"]).count() == 0


def test_month_ranges_empty_when_start_after_end(spark):
    assert calendar.month_ranges(spark, dt.date(2024, 5, 20), dt.date(2024, 5, 10)).count() == 0


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(min_value=-1500, max_value=3000), min_size=1, max_size=80),
       st.dates(min_value=dt.date(1995, 1, 1), max_value=dt.date(2040, 1, 1)), st.integers(0, 3000))
def test_month_year_range_predicate_is_exact(spark, keys, lo, span):
    from slicewright.operators.report_query import range_predicate

    hi = lo + dt.timedelta(days=span)
    df = spark.createDataFrame([(k,) for k in keys], "my bigint")
    got = sorted(r.my for r in df.where(range_predicate(df, "my", lo, hi, "month_year")).collect())
    want = sorted(k for k in keys if lo.replace(day=1) <= py_month_year(k) <= hi)
    assert got == want


def test_duplicate_key_sets_match_separate_audits(spark):
    from slicewright.sources import fixtures

    inv = reports.report_inventory_daily(fixtures.raw_report(spark, SF01, "inventory_daily"))
    k0 = registry.DUPLICATE_KEYS["inventory_daily"]
    k1 = registry.FULL_DUPLICATE_KEYS["inventory_daily"]
    both = audit.audit_duplicates_sets(inv, [k0, k1])
    for i, ks in enumerate((k0, k1)):
        got = sorted(tuple(r) for r in both.where(F.col("key_set") == i).select(*ks, "cnt").collect())
        want = sorted(tuple(r) for r in audit.audit_duplicates(inv, ks).collect())
        assert got == want and len(want) > 0
