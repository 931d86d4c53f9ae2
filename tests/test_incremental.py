"""C-3 with a ledger, C-5 by slice, C-7 row by row, K-13 coerced values, S-4 headers, A-3 from metadata."""

import datetime as dt
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from slicewright import registry
from slicewright.operators import audit as audit_ops
from slicewright.operators import reconcile
from slicewright.plans import jobs, reports
from slicewright.sources import csv_dump

from .test_sinks_jobs import _raw_fill, content, fr_rows, fresh

D = dt.date


# -- C-3: a broken backfill goes on where it stopped ---------------------------

def months(*changed):
    return [(20240105 + 100 * m, "u", m + (100 if m in changed else 0), 10, 0, 0, 0, 0.1) for m in range(4)]


def test_backfill_broken_in_its_second_month_reruns_the_rest(spark):
    t, log, ledger = fresh("bf_ledger"), fresh("bf_ledger_log"), fresh("ledger")
    raw = _raw_fill(spark, months())

    def breaking(raw):
        out = reports.report_fill_rate(raw)
        return out.withColumn("ad_requests", F.when(F.month("date") == 2, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("ad_requests")))

    args = dict(table=t, log_table=log, ledger=ledger)
    with pytest.raises(Exception, match="broken"):
        jobs.backfill(spark, "fill_rate", raw, "2024-01-01", "2024-04-30", pipeline=breaking, **args)
    assert content(spark, t) == [(D(2024, 1, 5), "u", 0)]
    out = jobs.backfill(spark, "fill_rate", raw, "2024-01-01", "2024-04-30", **args)
    assert [c["status"] for c in out["chunks"]] == ["SKIPPED", "SUCCESS", "SUCCESS", "SUCCESS"] and out["total_rows"] == 4
    assert content(spark, t) == [(D(2024, 1 + m, 5), "u", m) for m in range(4)]
    starts = [(r["slice_start"], r["status"]) for r in spark.table(log).orderBy("logged_at").collect()]
    assert starts == [(D(2024, 1, 1), "SUCCESS"), (D(2024, 2, 1), "FAILED"), (D(2024, 2, 1), "SUCCESS"), (D(2024, 3, 1), "SUCCESS"), (D(2024, 4, 1), "SUCCESS")]
    again = jobs.backfill(spark, "fill_rate", raw.repartition(3), "2024-01-01", "2024-04-30", **args)  # the same rows in another order
    assert {c["status"] for c in again["chunks"]} == {"SKIPPED"} and [c["running_total"] for c in again["chunks"]] == [1, 2, 3, 4]


def test_changed_input_and_other_tables_are_loaded(spark):
    t, ledger = fresh("bf_changed"), fresh("ledger")
    args = dict(log_table=None, ledger=ledger)
    jobs.backfill(spark, "fill_rate", _raw_fill(spark, months()), "2024-01-01", "2024-04-30", table=t, **args)
    out = jobs.backfill(spark, "fill_rate", _raw_fill(spark, months(2)), "2024-01-01", "2024-04-30", table=t, **args)
    assert [c["status"] for c in out["chunks"]] == ["SKIPPED", "SKIPPED", "SUCCESS", "SKIPPED"] and (D(2024, 3, 5), "u", 102) in content(spark, t)
    twice = _raw_fill(spark, months(2) + months(2)[3:])  # a repeated row is another input
    assert [c["status"] for c in jobs.backfill(spark, "fill_rate", twice, "2024-01-01", "2024-04-30", table=t, **args)["chunks"]][3] == "SUCCESS"
    other = fresh("bf_other")
    out = jobs.backfill(spark, "fill_rate", _raw_fill(spark, months()), "2024-01-01", "2024-04-30", table=other, **args)
    assert {c["status"] for c in out["chunks"]} == {"SUCCESS"}
    spark.sql(f"DROP TABLE {other}")
    out = jobs.backfill(spark, "fill_rate", _raw_fill(spark, months()), "2024-01-01", "2024-04-30", table=other, **args)
    assert {c["status"] for c in out["chunks"]} == {"SUCCESS"} and len(content(spark, other)) == 4


# -- C-5 by slice --------------------------------------------------------------

def test_incremental_audit_equals_the_whole_and_reads_changed_slices_only(spark, monkeypatch):
    t, store = fresh("fr_audit"), fresh("audit_slices")
    rows = [(D(2024, 1, d), u, 1, 10) for d in range(1, 8) for u in ("a", "b", "b", "c")[:d]]
    jobs.load(spark, "fill_rate", fr_rows(spark, rows), table=t, log_table=None)
    read = []
    real = jobs.audit_slices
    monkeypatch.setattr(jobs, "audit_slices", lambda df, spec: read.append(sorted(r[0] for r in df.select("date").distinct().collect())) or real(df, spec))

    def both():
        a = jobs.audit_incremental(spark, "fill_rate", store, spark.table(t)).collect()
        b = jobs.audit(spark, "fill_rate", spark.table(t)).collect()
        assert a == b
        return {r["check"]: r for r in a}

    assert both()["duplicates"]["value"] == 5 and len(read[-1]) == 7
    both()
    assert len(read) == 1  # nothing changed, nothing read
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, 7), "z", 1, 10), (D(2024, 1, 9), "z", 1, 10), (D(2024, 1, 9), "z", 2, 10)]), table=t, log_table=None)
    found = both()
    assert read[-1] == [D(2024, 1, 7), D(2024, 1, 9)] and found["total_rows"]["value"] == 1 + 2 + 3 + 3 * 4 + 1 + 2
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, 2), "q", 1, 10)]), mode="range", start=D(2024, 1, 1), end=D(2024, 1, 3), table=t, log_table=None)
    assert both()["date_range"]["detail"].startswith("2024-01-02 ..") and read[-1] == [D(2024, 1, 2)]  # two slices are gone, one is new


def test_audit_details(spark):
    rows = [(D(2024, 1, 1), u, k, 10) for k, u in enumerate("aaabbcddeeffgg")]
    found = {r["check"]: r for r in jobs.audit(spark, "fill_rate", fr_rows(spark, rows)).collect()}
    groups = found["duplicates"]["detail"].split("; ")
    assert groups[0] == "date=2024-01-01, ad_unit_name=a, cnt=3" and len(groups) == 5 and found["duplicates"]["value"] == 6
    assert found["sample"]["detail"].count("date=2024-01-01") == 3 and "ad_unit_name string" in found["schema"]["detail"]
    empty = {r["check"]: r for r in jobs.audit(spark, "fill_rate", fr_rows(spark, [])).collect()}
    assert empty["total_rows"]["value"] == 0 and empty["sample"]["detail"] is None


def test_profile_of_stored_tables_reads_no_data_column(spark):
    t = fresh("fr_meta")
    jobs.load(spark, "fill_rate", fr_rows(spark, [(D(2024, 1, d), "a", 1, 10) for d in range(1, 4)]), table=t, log_table=None)
    for df in (audit_ops.audit_profile(spark.table(t), "date"), audit_ops.audit_profiles({t: (spark.table(t), "date")}), audit_ops.audit_summary({t: spark.table(t)}),
               jobs.slice_fingerprints(spark.table(t), "date")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
        assert schemas and set(schemas) == {"struct<>"}, schemas
    assert audit_ops.audit_summary({t: spark.table(t)}).first()["row_count"] == 3


# -- C-7 row by row -------------------------------------------------------------

def test_reconcile_rows(spark):
    a = fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10), (D(2024, 1, 1), "a", 1, 10), (D(2024, 1, 2), "b", 2, 10), (D(2024, 1, 3), None, 3, 10), (None, "n", 4, 10), (D(2024, 1, 5), "e", 5, 0)])
    b = fr_rows(spark, [(D(2024, 1, 1), "a", 1, 10), (D(2024, 1, 2), "b", 2, 10), (D(2024, 1, 3), None, 9, 10), (D(2024, 1, 4), "d", 4, 10), (D(2024, 1, 5), "e", 5, 0)])
    got = sorted(((r["date"], r["ad_unit_name"], r["ad_server_impressions"], r["n_a"], r["n_b"], r["status"]) for r in reconcile.reconcile_rows(a, b, "date").collect()), key=str)
    want = [(D(2024, 1, 1), "a", 1, 2, 1, "count"), (D(2024, 1, 3), None, 3, 1, 0, "only_a"), (D(2024, 1, 3), None, 9, 0, 1, "only_b"), (D(2024, 1, 4), "d", 4, 0, 1, "only_b"), (None, "n", 4, 1, 0, "only_a")]
    assert got == sorted(want, key=str)
    assert reconcile.reconcile_rows(a, a.select(*reversed(a.columns)).repartition(5), "date").count() == 0
    assert reconcile.reconcile_rows(a.limit(0), a.limit(0), "date").count() == 0
    with pytest.raises(ValueError, match="columns differ"):
        reconcile.reconcile_rows(a, b.drop("ad_requests"), "date")


def test_untouched_slices_are_pruned(spark):
    t1, t2 = fresh("rec_a"), fresh("rec_b")
    rows = [(D(2024, 1, d), "a", d, 10) for d in range(1, 6)]
    jobs.load(spark, "fill_rate", fr_rows(spark, rows), table=t1, log_table=None)
    jobs.load(spark, "fill_rate", fr_rows(spark, rows[:2] + [(D(2024, 1, 3), "a", 99, 10)] + rows[3:]), table=t2, log_table=None)
    df = reconcile.reconcile_rows(spark.table(t1), spark.table(t2), "date")
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(filters) == 2 and all("2024-01-03" in x or "(date" in x for x in filters)
    files = set(spark.table(t1).where("date = date'2024-01-03'").inputFiles())
    assert df.count() == 2 and files and {os.path.basename(os.path.dirname(f)) for f in files} == {"date=2024-01-03"}


# -- K-13: values that became NULL -----------------------------------------------

def test_coerced_values_are_counted_per_column(spark):
    t, log = fresh("fr_coerced"), fresh("log_coerced")
    raw = spark.createDataFrame([("20240101", "u", "5", "10", None, "x", "-", "0.5"), ("20240101", "v", "abc", "1e400", "1", "2", "3", "nan"), ("20240102", "u", None, "", "1.5", "2", "3", None)],
                                "DATE string, AD_UNIT_NAME string, AD_SERVER_IMPRESSIONS string, AD_REQUESTS string, UNFILLED_IMPRESSIONS string, CODE_SERVED_COUNT string, RESPONSES_SERVED string, FILL_RATE string")
    raw = raw.withColumn("DATE", F.col("DATE").cast("bigint"))
    for _ in range(2):
        coerced = Observation(f"c{_}")
        out = jobs.load(spark, "fill_rate", reports.report_fill_rate(raw, coerced=coerced), table=t, log_table=log, coerced=coerced)
    want = {"ad_requests": 2, "ad_server_impressions": 1, "code_served_count": 1, "date": 0, "responses_served": 1, "unfilled_impressions": 1}
    got = out["coerced_by_column"]
    assert {k: got[k] for k in want} == want and out["coerced_to_null"] == sum(got.values())
    assert [r["coerced_by_column"] for r in spark.table(log).collect()] == [got, got]
    back = jobs.backfill(spark, "fill_rate", raw, "2024-01-01", "2024-01-31", table=fresh("bf_coerced"), log_table=log)
    assert back["total_rows"] == 3 and spark.table(log).where("coerced_to_null is not null").count() == 3


def test_every_pipeline_counts(spark):
    for name, pipe in {**reports.REPORT_PIPELINES, **reports.LEGACY_PIPELINES}.items():
        spec = registry.report(name)
        names = [*(spec.column_map or spec.csv_map)]
        raw = spark.createDataFrame([tuple({"DATE": "20240101", "MONTH_YEAR": "1401", "Dimension.DATE": "2024-01-01", "Dimension.MONTH_YEAR": "1401"}.get(c, "bad") for c in names)], names)
        coerced = Observation(f"every_{name}")
        kwargs = {"report_date": D(2024, 1, 1)} if name == "legacy_geo_monthly" else {}
        pipe(raw, coerced=coerced, **kwargs).collect()
        typed = [f.name for f in spec.schema.fields if f.dataType.simpleString() in ("bigint", "double")]
        got = coerced.get
        assert any(got.get(c) == 1 for c in typed), (name, got)


# -- S-4: headers ---------------------------------------------------------------

def test_headers_are_found_without_opening_files_on_the_driver(spark, scratch, monkeypatch):
    os.makedirs(f"{scratch}/in a/v 1")
    with open(f"{scratch}/in a/v 1/one.csv", "w", encoding="utf-8") as f:
        f.write("﻿Dimension.DATE,Column.X\r\n2024-01-01,1\r\n2024-01-02,2\r\n")
    with open(f"{scratch}/in a/two %.csv", "w", encoding="utf-8") as f:
        f.write('Column.X,"Dimension.DATE"\n"3\n4",2024-01-03\n')
    open(f"{scratch}/in a/empty.csv", "w").close()
    df = csv_dump.read_csv_dump(spark, f"{scratch}/in a/*")
    got = sorted((r["Dimension.DATE"], r["Column.X"]) for r in df.collect())
    assert got == [("2024-01-01", "1"), ("2024-01-02", "2"), ("2024-01-03", "3\n4")]
    source = open(csv_dump.__file__, encoding="utf-8").read()
    assert "_jvm" not in source and "open(" not in source
    assert csv_dump.read_csv_dump(spark, f"{scratch}/in a/empty.csv", ["a"]).columns == ["a"]


def test_one_header_reads_the_landing_as_a_whole(spark, scratch):
    csv_dump.write_csv_dump(spark.range(40).select(F.col("id").cast("string").alias("Dimension.N")).repartition(8), f"{scratch}/d")
    df = csv_dump.read_csv_dump(spark, f"{scratch}/d")
    assert df.count() == 40 and df.inputFiles() and csv_dump.dump_headers(spark, f"{scratch}/d").count() == 8
