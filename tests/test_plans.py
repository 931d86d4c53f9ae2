"""Plan shape: the properties the design relies on at scale, checked on the
physical plans of registered queries (sf0.01)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from slicewright import registry
from slicewright.operators import reconcile
from slicewright.plans import jobs, reports
from slicewright.sources import fixtures

from .conftest import SF01


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(p: str) -> int:
    # shuffle exchanges only (broadcasts are counted separately)
    return len(re.findall(r"^\(\d+\) Exchange", p, re.M))


@pytest.fixture(scope="module")
def q(spark):
    return lambda name: E.queries()[name](spark, SF01)


def test_report_pipeline_is_one_narrow_stage(q):
    p = plan(q("report_inventory_daily"))
    assert exchanges(p) == 0 and "Join" not in p
    # column pruning: the scan reads only the columns the extract uses
    read = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "l_extendedprice" not in read and "l_discount" not in read and "l_tax" not in read


def test_fill_rate_dedupe_is_partial_then_one_exchange(q):
    p = plan(q("report_fill_rate"))
    assert exchanges(p) == 1
    assert "partial_sum" in p


def test_report_query_pushes_the_range_to_the_scan(spark, q):
    from slicewright.operators import run_report

    li = fixtures.table(spark, SF01, "lineitem")
    p = plan(run_report(li, ["l_returnflag"], ["l_linenumber"], "1995-01-01", "1996-12-31", date_col="l_shipdate"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate.*LessThan\(l_shipdate", p)
    whole = plan(q("run_report_inventory"))  # no bounds: every row, also those without a date
    assert "PushedFilters" not in whole
    assert exchanges(p) == exchanges(whole) == 1 and "partial_sum" in whole


def test_reach_is_two_level_distinct(q):
    p = plan(q("run_report_reach"))
    assert "partial_count(distinct" in p or "count(distinct" in p
    assert exchanges(p) == 2  # (group, user) first, then group


def test_reconcile_is_union_plus_one_aggregate(spark):
    raw = fixtures.raw_report(spark, SF01, "fill_rate")
    typed = reports.transform(raw, registry.REPORTS["fill_rate"])
    r = reconcile.reconcile(typed, reports.report_fill_rate(raw), ["date"], ["ad_requests"])
    p = plan(r)
    assert "Join" not in p and "Union" in p
    assert exchanges(p) == 2  # the dedupe of one side, then the reconcile itself


def test_end_to_end_backfill_audit_reconcile(spark):
    raw = fixtures.raw_report(spark, SF01, "fill_rate")
    t = "fr_e2e"
    out = jobs.backfill(spark, "fill_rate", raw, "2024-01-01", "2024-01-31", chunked=True, table=t, log_table=None)
    expected = reports.report_fill_rate(raw).count()
    assert out["total_rows"] == expected == spark.table(t).count()
    findings = {r.check: r for r in jobs.audit(spark, "fill_rate", spark.table(t)).collect()}
    assert findings["duplicates"].value == 0 and findings["null_dates"].value == 0
    typed = reports.transform(raw, registry.REPORTS["fill_rate"])
    rec = reconcile.reconcile(typed, spark.table(t), ["date"], list(registry.FILL_RATE_SUM_COLUMNS),
                              only_differences=True)
    assert rec.count() == 0


def test_backfill_range_on_raw_keys_is_pushed(spark, tmp_path):
    from slicewright.operators.report_query import range_predicate

    path = str(tmp_path / "raw_fill_rate")
    fixtures.raw_report(spark, SF01, "fill_rate").write.parquet(path)
    raw = spark.read.parquet(path)
    q = raw.where(range_predicate(raw, "DATE", "2024-01-10", "2024-01-20", "date_int"))
    p = plan(q)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(DATE,20240110\).*LessThanOrEqual\(DATE,20240120\)", p)
    assert q.count() == raw.where("DATE between 20240110 and 20240120").count() > 0


def test_relative_reports_push_their_range(q):
    for name in ("run_report_yesterday", "run_report_last_month"):
        p = plan(q(name))
        assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate.*LessThan\(l_shipdate", p), name


def test_duplicate_audit_does_not_expand_rows(spark):
    from slicewright.operators import audit

    df = E.queries()["report_inventory_daily"](spark, SF01)
    keys = [registry.REPORTS["inventory_daily"].duplicate_key, registry.FULL_DUPLICATE_KEYS["inventory_daily"]]
    assert "Expand" not in plan(audit.audit_duplicates_sets(df, keys))


def test_profiles_share_their_exchanges(q):
    assert exchanges(plan(q("audit_profile"))) <= 4 and exchanges(plan(q("audit_summary"))) <= 2


def test_replace_with_known_slices_needs_no_join(q):
    for name in ("replace_day", "replace_month"):
        assert "Join" not in plan(q(name)), name


def test_local_today_is_the_report_zone_s():
    import datetime as dt

    from slicewright.operators.report_query import local_today, resolve_range

    late = dt.datetime(2024, 6, 30, 22, 30, tzinfo=dt.timezone.utc)  # 00:30 on July 1 in Paris
    assert local_today(late) == dt.date(2024, 7, 1)
    assert resolve_range("YESTERDAY", local_today(late)) == (dt.date(2024, 6, 30),) * 2
    assert resolve_range("LAST_MONTH", local_today(late)) == (dt.date(2024, 6, 1), dt.date(2024, 6, 30))
