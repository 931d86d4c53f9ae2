"""Versioned slices: what readers see during a replace, crashes between its steps, and clean-up."""

import datetime as dt
import threading

import pytest

from slicewright.plans import jobs
from slicewright.sinks import tables, versions
from slicewright.sources import tables as source_tables

from .test_sinks_jobs import SPEC, content, fr_rows, fresh

D = dt.date
DAYS = [D(2024, 1, d) for d in range(1, 6)]


def load(spark, t, rows, **kwargs):
    return jobs.load(spark, "fill_rate", fr_rows(spark, rows), table=t, log_table=None, **kwargs)


@pytest.fixture()
def table(spark):
    t = fresh("fr_versions")
    load(spark, t, [(d, u, 1, 10) for d in DAYS for u in "abc"])
    assert versions.is_versioned(spark, t)
    return t


def new_rows(days, n=2):
    return [(d, u, n, 10) for d in days for u in "xyzw"]


OLD, NEW = [("a", 1), ("b", 1), ("c", 1)], [("w", 2), ("x", 2), ("y", 2), ("z", 2)]


def by_day(spark, t):
    out = {}
    for d, u, n in content(spark, t):
        out.setdefault(d, []).append((u, n))
    return out


def test_planned_reader_keeps_the_old_rows(spark, table):
    before = spark.table(table)
    rows = sorted(before.collect(), key=str)
    files = before.inputFiles()
    load(spark, table, new_rows(DAYS[1:3]))
    assert sorted(spark.read.parquet(*files).select("ad_unit_name").collect()) == sorted((r["ad_unit_name"],) for r in rows)
    assert by_day(spark, table) == {d: NEW if d in DAYS[1:3] else OLD for d in DAYS}


@pytest.mark.parametrize("step", ["write", "first", "second", "drop"])
def test_a_crash_leaves_each_slice_old_or_new(spark, table, monkeypatch, step):
    """The range 2..4 is replaced by rows of 2 and 3; a step fails; a rerun finishes."""
    calls = []

    def failing(name, at):
        real = getattr(versions, name)

        def f(*args, **kwargs):
            calls.append(name)
            if calls.count(name) == at:
                raise RuntimeError("lost the driver")
            return real(*args, **kwargs)

        return f

    if step == "write":
        monkeypatch.setattr(versions, "switch", failing("switch", 1))
    else:
        monkeypatch.setattr(versions, "_point_at", failing("_point_at", {"first": 1, "second": 2, "drop": 3}[step]))
    rows = new_rows(DAYS[1:3])
    with pytest.raises(RuntimeError):
        load(spark, table, rows, mode="range", start=DAYS[1], end=DAYS[3])
    done = {"write": 0, "first": 0, "second": 1, "drop": 2}[step]
    assert by_day(spark, table) == {d: NEW if d in DAYS[1:1 + done] else OLD for d in DAYS}
    monkeypatch.undo()
    out = load(spark, table, rows, mode="range", start=DAYS[1], end=DAYS[3])
    want = {d: NEW if d in DAYS[1:3] else OLD for d in DAYS if d != DAYS[3]}
    assert by_day(spark, table) == want and out["dropped_partitions"] == [str(DAYS[3])]
    load(spark, table, rows, mode="range", start=DAYS[1], end=DAYS[3])
    assert by_day(spark, table) == want


def test_concurrent_reader_sees_whole_slices(spark, table):
    """Reads while the same days are replaced again and again: every slice is one load's, in full."""
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(by_day(spark, table))
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 7):
        load(spark, table, new_rows(DAYS[:3], n))
    stop.set()
    reader.join()
    assert not errors and len(seen) > 2
    loads = [OLD] + [[(u, n) for u in "wxyz"] for n in range(2, 7)]
    assert all(day[d] in loads for day in seen for d in DAYS) and all(len(day) == 5 for day in seen)


def test_old_versions_are_removed_and_current_ones_stay(spark, table):
    load(spark, table, new_rows(DAYS[:1]))
    load(spark, table, new_rows(DAYS[:1], 3))
    now = content(spark, table)
    assert versions.remove_old_versions(spark, table) == []  # all are young
    assert len(versions.versions_in_use(spark, table)) == 2
    assert len(versions.remove_old_versions(spark, table, dt.timedelta(0))) == 1
    assert content(spark, table) == now and versions.remove_old_versions(spark, table, dt.timedelta(0)) == []


def test_append_overwrite_and_new_slices(spark, table):
    load(spark, table, new_rows([D(2024, 2, 1)]))  # a slice that was not there
    load(spark, table, [(D(2024, 2, 1), "more", 5, 10), (D(2024, 3, 1), "more", 5, 10)], mode="append")
    got = by_day(spark, table)
    assert got[D(2024, 2, 1)] == sorted([*NEW, ("more", 5)]) and got[D(2024, 3, 1)] == [("more", 5)]
    load(spark, table, new_rows([D(2024, 3, 1)]))
    assert by_day(spark, table)[D(2024, 3, 1)] == NEW
    load(spark, table, new_rows(DAYS[:1]), mode="overwrite")
    assert by_day(spark, table) == {DAYS[0]: NEW}
    load(spark, table, new_rows(DAYS[:2], 9))
    assert by_day(spark, table)[DAYS[1]] == [(u, 9) for u in "wxyz"]


def test_external_table_and_rows_without_a_date(spark, scratch):
    t = fresh("fr_external")
    tables.ensure_table(spark, SPEC, t, location=f"{scratch}/fr", versioned=True)
    spark.sql(f"INSERT INTO {t} VALUES ('x', 0, 0, 0, 7, 0.1, 70, NULL), ('y', 0, 0, 0, 8, 0.1, 70, DATE'2024-01-01')")
    batch = spark.sql("select 'n' as ad_unit_name, 0L as unfilled_impressions, 0L as code_served_count, 0L as responses_served, "
                      "9L as ad_server_impressions, 0.1D as fill_rate, 70L as ad_requests, cast(null as date) as date")
    out = versions.replace(batch, t, "date")
    assert out["rows_written"] == 1
    assert content(spark, t) == [(None, "n", 9), (D(2024, 1, 1), "y", 8)]
    versions.replace(fr_rows(spark, [(D(2024, 1, 2), "z", 1, 1)]), t, "date", "2024-01-01", "2024-01-31")
    assert content(spark, t) == [(None, "n", 9), (D(2024, 1, 2), "z", 1)]
    with pytest.raises(ValueError, match="by name"):
        source_tables.read_report(spark, "fill_rate", path=f"{scratch}/fr")


def test_empty_batch_changes_nothing(spark, table):
    before = content(spark, table)
    for mode in ("slice", "range"):
        out = load(spark, table, [], mode=mode, start=DAYS[0], end=DAYS[-1])
        assert out["rows_inserted"] == 0 and content(spark, table) == before


@pytest.mark.parametrize("versioned", [True, False])
def test_slices_are_written_side_by_side_without_a_sort(spark, versioned):
    """A task sorts no rows of a few long days; with more slices than it may open, the rows are the same."""
    key, t = "spark.sql.maxConcurrentOutputFileWriters", fresh("fr_open")
    before = spark.conf.get(key, None)
    rows = [(D(2024, 1, 1) + dt.timedelta(days=k % 90), f"u{k}", k, 10) for k in range(360)]
    batch = fr_rows(spark, rows).coalesce(1)
    jobs.load(spark, "fill_rate", batch, table=t, log_table=None, versioned=versioned)
    assert content(spark, t) == sorted(r[:3] for r in rows)
    batch.createOrReplaceTempView("fr_open_batch")
    insert = f"EXPLAIN INSERT INTO {t} SELECT {', '.join(spark.table(t).columns)} FROM fr_open_batch"
    with tables.open_slices(spark), tables.open_slices(spark):
        assert "Sort" not in spark.sql(insert).first()[0]
    assert "Sort" in spark.sql(insert).first()[0] and spark.conf.get(key, None) == before


def test_a_load_writes_with_open_slices(spark, table, monkeypatch):
    seen, real = [], tables.open_slices

    def opened(session):
        seen.append(session)
        return real(session)

    monkeypatch.setattr(tables, "open_slices", opened)
    for mode in ("slice", "append"):
        load(spark, table, new_rows(DAYS[:1]), mode=mode)
    assert len(seen) == 2


def test_copies_are_made_in_many_tasks(spark):
    from pyspark.sql import functions as F

    from slicewright.plans import catalog

    made = catalog._copies(spark, spark.createDataFrame([("a", 25), (None, 11), ("b", 1), ("c", 10)], "raw_text string, n long").coalesce(1), piece=10)
    assert made.columns == ["raw_text", "n", "copy"]
    assert sorted((r["raw_text"] or "", r["n"], r["copy"]) for r in made.collect()) == sorted((t, n, k) for t, n in (("a", 25), ("", 11), ("b", 1), ("c", 10)) for k in range(1, n + 1))
    assert made.select(F.spark_partition_id()).distinct().count() > 1
