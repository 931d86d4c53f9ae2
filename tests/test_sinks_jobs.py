"""Sinks (K-*) and jobs (C-1, C-3, C-5, C-6)."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import types as T

from slicewright import registry
from slicewright.plans import jobs, reports
from slicewright.sinks import tables

D = dt.date
SPEC = registry.REPORTS["fill_rate"]


def fr_rows(spark, rows):
    """Typed fill-rate rows (date, unit, impressions, requests)."""
    data = [(d, u, 0, 9, 8, imp, (imp / req) if req else None, req) for d, u, imp, req in rows]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in SPEC.schema.fields])
    return spark.createDataFrame(data, nullable)


def fresh(name):
    return f"{name}_{uuid.uuid4().hex[:8]}"


def content(spark, table):
    spark.catalog.refreshTable(table)  # a stream writes through its own session
    rows = [(r.date, r.ad_unit_name, r.ad_server_impressions) for r in spark.table(table).collect()]
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or D.min, x[1] or "", x[2] or 0))


def test_replace_slice_idempotent_and_multi_day(spark):
    t = fresh("fr_slice")
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10), (D(2024, 1, 2), "a", 2, 10),
                                                  (D(2024, 1, 3), "a", 3, 10)]), table=t, log_table=None)
    batch = fr_rows(spark, [(D(2024, 1, 2), "b", 20, 10), (D(2024, 1, 3), "b", 30, 10)])
    r1 = jobs.load(spark, "fill_rate", batch, table=t, log_table=None)
    once = content(spark, t)
    jobs.load(spark, "fill_rate", batch, table=t, log_table=None)
    assert content(spark, t) == once == [(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "b", 20), (D(2024, 1, 3), "b", 30)]
    assert r1["rows_inserted"] == 2 and r1["status"] == "SUCCESS"


def test_replace_range_empties_days_without_rows_and_keeps_null_dates(spark):
    t = fresh("fr_range")
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, d), "a", d, 10) for d in range(1, 6)]),
              table=t, log_table=None)
    # D12: a NULL-date row in the stored table (written around the checks).
    spark.sql(f"INSERT INTO {t} VALUES ('x', 0, 0, 0, 7, 0.1, 70, NULL)")
    batch = fr_rows(spark, [(D(2024, 1, 2), "new", 200, 10), (D(2024, 1, 4), "new", 400, 10)])
    out = jobs.load(spark, "fill_rate", batch, mode="range", start="2024-01-02", end="2024-01-04",
                    table=t, log_table=None)
    assert out["dropped_partitions"] == ["2024-01-03"]
    got = content(spark, t)
    assert got[0] == (None, "x", 7)
    assert got[1:] == [
        (D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "new", 200), (D(2024, 1, 4), "new", 400), (D(2024, 1, 5), "a", 5)]
    # rerun gives the same table
    jobs.load(spark, "fill_rate", batch, mode="range", start="2024-01-02", end="2024-01-04", table=t, log_table=None)
    assert content(spark, t) == got


def test_empty_batch_is_noop(spark):
    t = fresh("fr_empty")
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10)]), table=t, log_table=None)
    empty = fr_rows(spark, []).where("false")
    out = jobs.load(spark, "fill_rate", empty, mode="range", start="2024-01-01", end="2024-01-31",
                    table=t, log_table=None)
    assert out["rows_inserted"] == 0 and out["status"] == "SUCCESS"
    assert content(spark, t) == [(D(2024, 1, 1), "a", 1)]
    for mode in ("slice", "append", "overwrite"):
        out = jobs.load(spark, "fill_rate", empty, mode=mode, table=t, log_table=None)
        assert out["rows_inserted"] == 0 and out["status"] == "SUCCESS"
        assert content(spark, t) == [(D(2024, 1, 1), "a", 1)], mode


def test_required_null_fails_before_writing(spark):
    t = fresh("fr_null")
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10)]), table=t, log_table=None)
    bad = fr_rows(spark, [(D(2024, 1, 1), "b", 5, 10), (None, "c", 1, 1)])
    with pytest.raises(Exception):
        jobs.load(spark, "fill_rate", bad, table=t, log_table=None)
    assert content(spark, t) == [(D(2024, 1, 1), "a", 1)]


def test_conform_rejects_extra_and_missing(spark):
    df = fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10)])
    with pytest.raises(tables.SchemaMismatch):
        tables.conform(df.drop("ad_requests"), SPEC)
    with pytest.raises(tables.SchemaMismatch):
        tables.conform(df.withColumn("junk", df.ad_requests), SPEC)
    assert tables.conform(df.withColumn("junk", df.ad_requests), SPEC, extra="drop").columns == SPEC.columns


def test_monthly_batch_with_two_months_replaces_both(spark):
    t = fresh("geo")
    spec = registry.REPORTS["geo_monthly"]

    def geo(rows):
        return spark.createDataFrame([(d, c, c, n, 0, None, 0) for d, c, n in rows], spec.schema)

    jobs.load(spark, "geo_monthly", geo([(D(2025, 1, 1), "FR", 1), (D(2025, 2, 1), "FR", 2), (D(2025, 3, 1), "FR", 3)]),
              table=t, log_table=None)
    jobs.load(spark, "geo_monthly", geo([(D(2025, 2, 1), "DE", 20), (D(2025, 3, 1), "DE", 30)]), table=t, log_table=None)
    got = sorted((r.report_date, r.country_code) for r in spark.table(t).collect())
    assert got == [(D(2025, 1, 1), "FR"), (D(2025, 2, 1), "DE"), (D(2025, 3, 1), "DE")]


def test_append_overwrite_dry_run_and_log(spark):
    t, log = fresh("fr_app"), fresh("log")
    df = fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10), (D(2024, 1, 2), "b", 2, 0)])
    jobs.load(spark, "fill_rate", df, mode="append", table=t, log_table=log)
    jobs.load(spark, "fill_rate", df, mode="append", table=t, log_table=log)
    assert spark.table(t).count() == 4
    jobs.load(spark, "fill_rate", df.limit(1), mode="overwrite", table=t, log_table=log)
    assert spark.table(t).count() == 1
    dry = jobs.load(spark, "fill_rate", df, dry_run=True, table=t, log_table=log)
    assert dry["status"] == "DRY_RUN" and dry["rows"] == 2 and len(dry["sample"]) == 2
    # the table holds only the first day: the dry run shows what a reload would change
    assert [(d["date"], d["status"]) for d in dry["diff"].collect()] == [(D(2024, 1, 2), "only_b")]
    logged = spark.table(log).orderBy("logged_at").collect()
    assert [r.rows_written for r in logged] == [2, 2, 1]
    assert all(r.status == "SUCCESS" and r.report_type == "fill_rate" for r in logged)


def _raw_fill(spark, rows):
    return spark.createDataFrame(rows, "DATE bigint, AD_UNIT_NAME string, AD_SERVER_IMPRESSIONS bigint, "
                                       "AD_REQUESTS bigint, UNFILLED_IMPRESSIONS bigint, CODE_SERVED_COUNT bigint, "
                                       "RESPONSES_SERVED bigint, FILL_RATE double")


def test_backfill_chunked_equals_single_job(spark):
    raw = _raw_fill(spark, [(20240115 + 100 * m, "u", m, 10, 0, 0, 0, 0.1) for m in range(0, 3)]
                    + [(20240131, "u", 5, 10, 0, 0, 0, 0.5)])
    t1, t2 = fresh("bf1"), fresh("bf2")
    s1 = jobs.backfill(spark, "fill_rate", raw, "2024-01-10", "2024-03-20", table=t1, log_table=None)
    s2 = jobs.backfill(spark, "fill_rate", raw, "2024-01-10", "2024-03-20", chunked=True, table=t2, log_table=None)
    assert content(spark, t1) == content(spark, t2)
    assert s1["total_rows"] == s2["total_rows"] == 4
    assert [c["month_label"] for c in s2["chunks"]] == ["January 2024", "February 2024", "March 2024"]
    assert [c["running_total"] for c in s2["chunks"]] == [2, 3, 4]
    assert s2["chunks"][0]["start"] == D(2024, 1, 10) and s2["chunks"][-1]["end"] == D(2024, 3, 20)


def test_backfill_leaves_months_without_rows(spark):
    """K-10 within a range: an empty month and a mid-month start, in one job and in chunks."""
    for chunked in (False, True):
        t = fresh("bf_empty")
        frame = spark.createDataFrame([(f"{m}",) for m in (1, 2, 3)], "m string").selectExpr(
            "make_date(2024, cast(m as int), 1) as report_date", "'France' as country_name", "'FR' as country_code",
            "cast(m as bigint) as ad_server_impressions", "0L as ad_server_clicks", "cast(null as double) as active_view_measurable_rate",
            "0L as active_view_viewable_impressions")
        jobs.load(spark, "geo_monthly", frame, table=t, log_table=None)
        raw = spark.createDataFrame([("France", "FR", 1401, 50, 1, "0.5", 3)],
                                    "COUNTRY_NAME string, COUNTRY_CODE string, MONTH_YEAR bigint, IMPRESSIONS bigint, CLICKS bigint, "
                                    "AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE string, AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS bigint")
        jobs.backfill(spark, "geo_monthly", raw, "2024-01-15", "2024-03-10", chunked=chunked, table=t, log_table=None)
        spark.catalog.refreshTable(t)
        assert sorted((r.report_date, r.ad_server_impressions) for r in spark.table(t).collect()) == [
            (D(2024, 1, 1), 1), (D(2024, 2, 1), 50), (D(2024, 3, 1), 3)]
        t = fresh("bf_days")  # days: January 3 goes (January has rows), February stays (it has none)
        jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, 2), "a", 1, 10), (D(2024, 1, 3), "a", 2, 10), (D(2024, 2, 5), "a", 3, 10)]),
                  table=t, log_table=None)
        jobs.backfill(spark, "fill_rate", _raw_fill(spark, [(20240102, "u", 9, 10, 0, 0, 0, 0.1)]), "2024-01-02", "2024-03-01",
                      chunked=chunked, table=t, log_table=None)
        assert content(spark, t) == [(D(2024, 1, 2), "u", 9), (D(2024, 2, 5), "a", 3)]


def test_backfill_from_month_folders_and_functions(spark, scratch):
    """Dumps without a month: dated by their folder, by the asked month, or refused."""
    from slicewright.sources import csv_dump

    names = "`Dimension.COUNTRY_NAME` string, `Dimension.COUNTRY_CRITERIA_ID` string, `Column.AD_SERVER_IMPRESSIONS` string, chunk_start string"
    frame = spark.createDataFrame([("France", "2250", "5", "2024-01-01"), ("Spain", "2724", "-", "2024-02-01"), (None, "0", "9", "2024-02-01")], names)
    path = os.path.join(scratch, "geo_csv")
    csv_dump.write_csv_dump(frame, path, "chunk_start")
    want = [(D(2024, 1, 1), "France", 5), (D(2024, 2, 1), "Spain", None)]

    def stored(t):
        spark.catalog.refreshTable(t)
        return sorted((r.report_date, r.country_name, r.ad_server_impressions) for r in spark.table(t).collect())

    def pipeline(raw, report_date=None):
        from pyspark.sql import functions as F

        absent = ("ad_server_clicks", "active_view_viewable_impressions")
        out = reports.csv_geo_monthly(raw, report_date)
        return out.withColumns({c: F.lit(None).cast("bigint") for c in absent} | {"active_view_measurable_rate": F.lit(None).cast("double")})

    t, log = fresh("bf_folder"), fresh("bf_log")
    out = jobs.backfill(spark, "geo_monthly", csv_dump.read_csv_dump(spark, path), "2024-01-15", "2024-02-10", table=t, pipeline=pipeline, log_table=log)
    assert stored(t) == want and out["total_rows"] == 2
    assert [(r.rows_read, r.rows_written) for r in spark.table(log).collect()] == [(3, 2)]

    def month(lo, hi):
        return csv_dump.read_csv_dump(spark, f"{path}/chunk_start={lo.replace(day=1)}")

    t = fresh("bf_asked")
    assert len(jobs.backfill(spark, "geo_monthly", month, "2024-01-15", "2024-02-10", table=t, pipeline=pipeline, log_table=None)["chunks"]) == 2
    assert stored(t) == want
    with pytest.raises(ValueError, match="month"):
        jobs.backfill(spark, "geo_monthly", frame.drop("chunk_start"), "2024-01-01", "2024-02-10", table=t, pipeline=pipeline, log_table=None)
    legacy = spark.createDataFrame([("2024-01-05", "7", "hp", "5", "d5d"), ("2024-03-05", "8", "hp", "6", "1")],
                                   "`Dimension.DATE` string, `Dimension.AD_UNIT_ID` string, `Dimension.AD_UNIT_NAME` string, "
                                   "`Column.AD_SERVER_IMPRESSIONS` string, `Column.AD_SERVER_CLICKS` string")

    def legacy_pipeline(raw):
        from pyspark.sql import functions as F

        out = reports.legacy_inventory_daily(raw)
        return out.withColumns({"order_id": F.lit(1).cast("bigint"), "order_name": F.lit("o"), "device_category": F.lit("d"), "creative_size": F.lit("c")})

    t = fresh("bf_legacy")
    jobs.backfill(spark, "legacy_inventory_daily", legacy, "2024-01-01", "2024-02-10", table=t, pipeline=legacy_pipeline, log_table=None)
    spark.catalog.refreshTable(t)
    assert [(r.date, r.ad_unit_id, r.ad_server_impressions, r.ad_server_clicks) for r in spark.table(t).collect()] == [(D(2024, 1, 5), 7, 5, None)]


def test_log_times_are_instants(spark):
    log = fresh("log_time")
    before = dt.datetime.now(dt.timezone.utc)
    jobs.log_load(spark, {"status": "SUCCESS", "message": "x" * 5000}, log)
    r = spark.sql(f"select unix_micros(logged_at) as t, message from {log}").first()
    assert abs(r.t / 1e6 - before.timestamp()) < 120 and len(r.message) == 5000


def test_audit_and_audit_all(spark):
    t = fresh("fr_audit")
    df = fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10), (D(2024, 1, 2), "b", 2, 0)])
    jobs.load(spark, "fill_rate", df, mode="append", table=t, log_table=None)
    jobs.load(spark, "fill_rate", df.limit(1), mode="append", table=t, log_table=None)
    f = {r.check: r for r in jobs.audit(spark, "fill_rate", spark.table(t)).collect()}
    assert f["total_rows"].value == 3 and f["null_dates"].status == "OK"
    assert f["duplicates"].value == 1 and f["duplicates"].status == "WARNING"
    assert f["date_range"].value == 2
    assert "duplicates_full_key" not in f  # only the inventory report has a second key
    allf = jobs.audit_all(spark, ["no_such_table", "report_fill_rate_absent"]).collect()
    assert {r.status for r in allf} == {"ERROR"} and len(allf) == 2
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW report_fill_rate AS SELECT * FROM {t}")
    try:
        mixed = jobs.audit_all(spark, ["no_such_table", "report_fill_rate"]).collect()
    finally:
        spark.catalog.dropTempView("report_fill_rate")
    assert [r.value for r in mixed if r.check == "summary"] == [3]
    assert any(r.status == "ERROR" for r in mixed) and any(r.check == "duplicates" for r in mixed)


def test_restate_from_own_table_with_materialize(spark):
    t = fresh("fr_self")
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, d), "a", d, 10) for d in range(1, 4)]),
              table=t, log_table=None)
    from pyspark.sql import functions as F
    restated = spark.table(t).where(F.col("date") == D(2024, 1, 2)) \
        .withColumn("ad_server_impressions", F.col("ad_server_impressions") * 10)
    jobs.load(spark, "fill_rate", restated, table=t, log_table=None, materialize=True)
    assert content(spark, t) == [(D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "a", 20), (D(2024, 1, 3), "a", 3)]
    tables.drop_partitions(spark, t, "date", ["2024-01-01", "2024-01-03"])
    assert content(spark, t) == [(D(2024, 1, 2), "a", 20)]


def test_backfill_keeps_only_the_range_and_runs_several_reports(spark):
    raw = _raw_fill(spark, [(20240105, "u", 1, 10, 0, 0, 0, 0.1), (20240215, "u", 2, 10, 0, 0, 0, 0.1),
                            (20240320, "u", 3, 10, 0, 0, 0, 0.1)])
    geo_raw = spark.createDataFrame([("France", "FR", 1401, 5, 1, "0.5", 3), ("Spain", "ES", 1402, 6, 1, "-", 2)],
                                    "COUNTRY_NAME string, COUNTRY_CODE string, MONTH_YEAR bigint, IMPRESSIONS bigint, "
                                    "CLICKS bigint, AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE string, "
                                    "AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS bigint")
    t_fr, t_geo = fresh("bf_fr"), fresh("bf_geo")
    r1 = jobs.backfill(spark, "fill_rate", raw, "2024-02-10", "2024-02-20", table=t_fr, log_table=None)
    assert r1["total_rows"] == 1 and content(spark, t_fr) == [(D(2024, 2, 15), "u", 2)]
    # month_year 1401 = Feb 2024: a mid-month range still loads the February slice
    r2 = jobs.backfill(spark, "geo_monthly", geo_raw, "2024-02-10", "2024-02-20", table=t_geo, log_table=None)
    assert r2["total_rows"] == 1
    spark.catalog.refreshTable(t_geo)
    assert [(r.report_date, r.country_code) for r in spark.table(t_geo).collect()] == [(D(2024, 2, 1), "FR")]
    many = jobs.backfill_reports(spark, {"fill_rate": raw}, "2024-01-01", "2024-01-31",
                                 reports_=("fill_rate", "geo_monthly"), log_table=None,
                                 table=fresh("bf_many"))
    assert [m["status"] for m in many] == ["SUCCESS", "SKIPPED"]


def test_hot_day_is_split_across_write_tasks(spark):
    # One day holds almost all rows: REBALANCE lets AQE split it into several
    # files (advisory size made tiny here so the split shows at test scale).
    t = fresh("fr_hot")
    rows = [(D(2024, 1, 1), f"u{i}", i, 10) for i in range(20000)] + [(D(2024, 1, 2), "x", 1, 1)]
    batch = fr_rows(spark, rows).repartition(8)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "32k")
    try:
        out = jobs.load(spark, "fill_rate", batch, table=t, log_table=None)
    finally:
        spark.conf.set(key, old)
    assert out["rows_inserted"] == 20001
    files = spark.table(t).inputFiles()
    hot = [f for f in files if "date=2024-01-01" in f]
    cold = [f for f in files if "date=2024-01-02" in f]
    assert len(hot) > 1 and len(cold) == 1
    assert spark.table(t).count() == 20001


def test_legacy_reports_load_through_the_same_sinks(spark):
    spec = registry.LEGACY_REPORTS["geo_monthly"]
    t = fresh("legacy_geo")
    df = spark.createDataFrame([(D(2025, 1, 1), 2250, "France", 10, 1), (D(2025, 2, 1), 2250, "France", 12, 2)],
                               T.StructType([T.StructField(f.name, f.dataType, True) for f in spec.schema.fields]))
    out = jobs.load(spark, "legacy_geo_monthly", df, table=t, log_table=None)
    assert out["rows_inserted"] == 2 and out["report_type"] == "legacy_geo_monthly"
    f = {r.check: r for r in jobs.audit(spark, "legacy_geo_monthly", spark.table(t)).collect()}
    assert f["total_rows"].value == 2 and f["duplicates"].value == 0


def test_kpi_view_prunes_and_computes_percentages(spark):
    from slicewright.plans.views import create_kpi_view

    t = fresh("fr_kpi")
    rows = [(D(2025, 11, 23), "x", 0, 125000, 0, 98000, 98000 / 150000, 150000), (D(2025, 11, 24), "y", 0, 1, 0, 1, None, 0)]
    jobs.load(spark, "fill_rate", spark.createDataFrame(rows, SPEC.schema), table=t, log_table=None)
    v = create_kpi_view(spark, t, temporary=True)
    got = {r.ad_unit_name: (r.fill_rate_percent, r.serve_rate_percent) for r in spark.table(v).collect()}
    assert round(got["x"][0], 2) == 65.33 and round(got["x"][1], 2) == 83.33
    assert got["y"] == (None, None)
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spark.table(v).where("date = DATE'2025-11-23'").explain()
    assert "PartitionFilters: [isnotnull(date" in buf.getvalue()


def test_load_survives_failed_task_attempts(spark):
    # The test session runs local[4,2]: a task may fail once and is retried.
    # A (test-only) UDF makes the first attempt of some tasks fail; the table
    # and the observed row count must come out exactly as without failures.
    from pyspark import TaskContext
    from pyspark.sql import functions as F

    @F.udf("bigint")
    def flaky(v):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("simulated lost task")
        return v

    t = fresh("fr_flaky")
    rows = [(D(2024, 1, 1 + d % 5), f"u{d}", d, 10) for d in range(200)]
    batch = fr_rows(spark, rows).repartition(4).withColumn("ad_server_impressions", flaky("ad_server_impressions"))
    out = jobs.load(spark, "fill_rate", batch, table=t, log_table=None)
    assert out["rows_inserted"] == 200
    assert spark.table(t).count() == 200
    assert spark.table(t).agg(F.sum("ad_server_impressions")).first()[0] == sum(range(200))


def test_inventory_audit_reports_both_keys(spark):
    spec = registry.REPORTS["inventory_daily"]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in spec.schema.fields])
    rows = [(D(2024, 1, 1), "top_a", "u", "o", "Desktop", "728 x 90", 1, 0, 1, 1),
            (D(2024, 1, 1), "top_b", "u", "o", "Desktop", "728 x 90", 2, 0, 1, 1),
            (D(2024, 1, 2), "top_a", "u", "o", "Desktop", "728 x 90", 3, 0, 1, 1),
            (D(2024, 1, 2), "top_a", "u", "o", "Desktop", "728 x 90", 4, 0, 1, 1)]
    df = spark.createDataFrame(rows, nullable)
    f = {r.check: r for r in jobs.audit(spark, "inventory_daily", df).collect()}
    assert f["duplicates"].value == 2      # (day 1: top level differs) and day 2
    assert f["duplicates_full_key"].value == 1   # only day 2 repeats the full key
    assert "2024-01-01" in f["duplicates"].detail or "2024, 1, 1" in f["duplicates"].detail


def test_range_replace_on_external_table_removes_files(spark, scratch):
    t = fresh("fr_ext")
    loc = os.path.join(scratch, "ext_table")
    tables.ensure_table(spark, SPEC, t, location=loc)
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, d), "a", d, 10) for d in range(1, 4)]),
              table=t, log_table=None)
    out = jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, 1), "b", 9, 10)]), mode="range",
                    start="2024-01-01", end="2024-01-03", table=t, log_table=None)
    assert out["dropped_partitions"] == ["2024-01-02", "2024-01-03"]
    assert content(spark, t) == [(D(2024, 1, 1), "b", 9)]
    # the files are gone too: a path read (or a partition recovery) sees the same rows
    assert [(r.ad_unit_name, r.ad_server_impressions) for r in spark.read.parquet(loc).collect()] == [("b", 9)]
    from slicewright.sources import tables as src_tables
    by_path = src_tables.read_report(spark, "fill_rate", path=loc)
    assert by_path.schema["date"].dataType.simpleString() == "date"
    assert [(r.date, r.ad_unit_name) for r in by_path.collect()] == [(D(2024, 1, 1), "b")]


def test_range_load_rejects_rows_outside_the_range(spark):
    t = fresh("fr_outside")
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10)]), table=t, log_table=None)
    bad = fr_rows(spark, [(D(2024, 1, 2), "b", 2, 10), (D(2024, 2, 1), "c", 3, 10)])
    with pytest.raises(Exception):
        jobs.load(spark, "fill_rate", bad, mode="range", start="2024-01-01", end="2024-01-31", table=t, log_table=None)
    assert content(spark, t) == [(D(2024, 1, 1), "a", 1)]


@pytest.mark.parametrize("report,pipeline", [
    ("fill_rate", reports.report_fill_rate),
    ("inventory_daily", reports.report_inventory_daily),
    ("geo_monthly", reports.report_geo_backfill),  # REST geo keeps NULL-name subtotals; REQUIRED rejects them
    ("audience_interest", reports.report_audience_interest),
    ("audience_demographics", reports.report_audience_demographics),
])
def test_every_report_loads_into_its_table(spark, report, pipeline):
    from slicewright.sources import fixtures

    from .conftest import SF001

    batch = pipeline(fixtures.raw_report(spark, SF001, report))
    t = fresh(f"all_{report}")
    out = jobs.load(spark, report, batch, table=t, extra_columns="drop", log_table=None)
    spark.catalog.refreshTable(t)
    stored = spark.table(t)
    assert out["rows_inserted"] == batch.count() == stored.count() > 0
    spec = registry.REPORTS[report]
    assert {f.name: f.dataType for f in stored.schema.fields} == {f.name: f.dataType for f in spec.schema.fields}
