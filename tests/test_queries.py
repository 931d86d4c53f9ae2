"""Report query operators (Q-1 … Q-6), SQL/table sources and plan shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slicewright import registry
from slicewright.operators import report_query as rq
from slicewright.plans import jobs, reports
from slicewright.sources import tables

D = dt.date


def test_resolve_range():
    today = D(2025, 3, 1)
    assert rq.resolve_range("YESTERDAY", today) == (D(2025, 2, 28), D(2025, 2, 28))
    assert rq.resolve_range("LAST_MONTH", today) == (D(2025, 2, 1), D(2025, 2, 28))
    assert rq.resolve_range("LAST_MONTH", D(2025, 1, 15)) == (D(2024, 12, 1), D(2024, 12, 31))
    assert rq.resolve_range("CUSTOM_DATE", today, "2025-01-15", "2025-01-20") == (D(2025, 1, 15), D(2025, 1, 20))
    assert rq.resolve_range("CUSTOM_DATE", today, "2025-01-15", None) == (None, None)
    with pytest.raises(ValueError):
        rq.resolve_range("NEXT_YEAR", today)


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame([
        (D(2025, 1, 1), "hp", "Desktop", 10, 1, "u1"),
        (D(2025, 1, 1), "hp", "Mobile", 5, 0, "u2"),
        (D(2025, 1, 2), "hp", "Desktop", 7, 2, "u1"),
        (D(2025, 1, 2), "news", "Desktop", 1, 0, "u3"),
        (D(2025, 2, 1), "hp", "Desktop", 100, 9, "u1"),
    ], "date date, ad_unit string, device string, imp bigint, clk bigint, user string")


def test_run_report_range_and_reach(facts):
    out = rq.run_report(facts, ["date", "ad_unit"], {"imp": "imp", "clk": "clk"},
                        "2025-01-01", "2025-01-31", date_col="date", reach="user").collect()
    got = sorted(tuple(r) for r in out)
    assert got == [(D(2025, 1, 1), "hp", 15, 1, 2), (D(2025, 1, 2), "hp", 7, 2, 1), (D(2025, 1, 2), "news", 1, 0, 1)]
    approx = rq.run_report(facts, ["ad_unit"], {"imp": "imp"}, reach="user", approx_reach=True).collect()
    assert {r.ad_unit: r.unique_reach for r in approx} == {"hp": 2, "news": 1}


def test_totals_and_drop_subtotals(facts):
    tot = rq.run_report(facts, ["ad_unit", "device"], {"imp": "imp"}, totals=True)
    rows = {(r.ad_unit, r.device, r.grouping_level): r.imp for r in tot.collect()}
    assert rows[(None, None, 3)] == 123 and rows[("hp", None, 1)] == 122 and rows[("hp", "Mobile", 0)] == 5
    detail = rq.drop_subtotals(tot)
    assert "grouping_level" not in detail.columns and detail.count() == 3
    # extract that came with NULL-key subtotal rows
    ext = facts.select("ad_unit", "imp").union(facts.sparkSession.createDataFrame([(None, 123)], "ad_unit string, imp bigint"))
    assert rq.drop_subtotals(ext, keys=["ad_unit"]).count() == 5


def test_range_predicate_encodings(spark):
    df = spark.createDataFrame([(20250131, -1488, "2025-01-31 23:59:00")], "d bigint, my bigint, ts string") \
        .withColumn("ts", F.to_timestamp("ts"))
    # month_year -1488 is 1996-01 (floor semantics)
    for col, enc in (("d", "date_int"), ("my", "month_year"), ("ts", None)):
        lo, hi = ("1996-01-01", "1996-01-31") if col == "my" else ("2025-01-31", "2025-01-31")
        assert df.where(rq.range_predicate(df, col, lo, hi, enc)).count() == 1
        assert df.where(rq.range_predicate(df, col, "2026-01-01", "2026-12-31", enc)).count() == 0


def test_hierarchy_levels_short_paths(spark):
    df = spark.createDataFrame([("site/sport/foot",), ("site",)], "p string")
    out = rq.hierarchy_levels(df, "p", 3).collect()
    assert [tuple(r)[1:] for r in out] == [("site", "sport", "foot"), ("site", None, None)]


def test_sql_source_and_table_scan_with_partition_pruning(spark):
    t = "fr_scan_" + str(abs(hash("scan")) % 10000)
    spec = registry.REPORTS["fill_rate"]
    rows = [(D(2024, 1, d), "u", 0, 0, 0, d, 0.1, 10) for d in range(1, 11)]
    jobs.load(spark, "fill_rate", spark.createDataFrame(rows, spec.schema), table=t, log_table=None)
    df = tables.read_report(spark, t)
    q = rq.run_report(df, ["ad_unit_name"], {"imp": "ad_server_impressions"}, "2024-01-03", "2024-01-04",
                      date_col="date")
    assert q.first().imp == 7
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-03" in plan
    s = tables.query(spark, "select count(*) as n from {t} where date >= '2024-01-05'", t=df)
    assert s.first().n == 6
    assert tables.query(spark, f"select count(*) as n from {t}").first().n == 10


def test_present_orders_by_keys(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (1, "a")], "d int, u string")
    assert [tuple(r) for r in reports.present(df, ["d", "u"]).collect()] == [(1, None), (1, "a"), (2, "b")]
