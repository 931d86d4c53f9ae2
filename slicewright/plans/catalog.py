"""Named queries over the shared test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
library's operators: lazy, but for the queries over landings (``*_pages``,
``csv_*``, ``legacy_*``) and tables (``load_*``, ``job_*``), which first write
their landing or table under the checkpoint folder, anew on every call.
``__spark_entry__`` registers them; ``bench.py`` times them.  Every one reads
whole tables: no id subsets or row caps.
"""

from __future__ import annotations

from collections.abc import Callable

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import registry
from ..functions import dates, demographics, kpi
from ..functions.coerce import to_float64, to_int64
from ..operators import audit, calendar, reach, reconcile, report_query, setops
from ..session import scratch_path
from ..sinks import tables
from ..sources import csv_dump, fixtures, pages
from ..sources import tables as source_tables
from . import jobs, reports

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark, sf_dir, report):
    return fixtures.raw_report(spark, sf_dir, report)


# -- report pipelines (J-7) -------------------------------------------------

def q_report_fill_rate(spark, sf_dir):
    return reports.report_fill_rate(_raw(spark, sf_dir, "fill_rate"))


def q_report_inventory_daily(spark, sf_dir):
    return reports.report_inventory_daily(_raw(spark, sf_dir, "inventory_daily"))


def q_report_geo_monthly(spark, sf_dir):
    return reports.report_geo_monthly(_raw(spark, sf_dir, "geo_monthly"))


def q_report_geo_backfill(spark, sf_dir):
    return reports.report_geo_backfill(_raw(spark, sf_dir, "geo_monthly"))


def q_report_audience_interest(spark, sf_dir):
    return reports.report_audience_interest(_raw(spark, sf_dir, "audience_interest"))


def q_report_audience_demographics(spark, sf_dir):
    return reports.report_audience_demographics(_raw(spark, sf_dir, "audience_demographics"))


# -- report query (Q-1 … Q-6) ---------------------------------------------------

def q_run_report_inventory(spark, sf_dir):
    """Q-1: daily delivery by ad unit and device over the whole history (a custom range without bounds)."""
    li = fixtures.table(spark, sf_dir, "lineitem")
    return report_query.run_report(
        li,
        dimensions={"date": F.to_date("l_shipdate"), "ad_unit_name": "l_returnflag",
                    "device_category": "l_linestatus"},
        metrics={"ad_server_impressions": F.col("l_quantity").cast("bigint"),
                 "ad_server_clicks": F.col("l_linenumber").cast("bigint")},
        **dict(zip(("start", "end"), report_query.resolve_range("CUSTOM_DATE"))), date_col="l_shipdate",
    )


def q_run_report_totals(spark, sf_dir):
    """Q-4: yearly delivery per ad unit with subtotal and grand-total rows."""
    li = fixtures.table(spark, sf_dir, "lineitem")
    return report_query.run_report(
        li,
        dimensions={"ship_year": F.year("l_shipdate"), "ad_unit_name": "l_returnflag"},
        metrics={"ad_server_impressions": F.col("l_quantity").cast("bigint")},
        totals=True,
    )


def q_run_report_reach(spark, sf_dir):
    """Q-6: daily events and unique users per ad unit (exact distinct count)."""
    ev = fixtures.table(spark, sf_dir, "events")
    return report_query.run_report(
        ev,
        dimensions={"date": F.to_date("ts"), "ad_unit_name": "event_type"},
        metrics={"events": F.lit(1).cast("bigint")},
        reach="user_id", reach_name="unique_reach",
    )


def q_run_report_reach_totals(spark, sf_dir):
    """Q-4 + Q-6: exact reach per month and ad unit, with subtotals and the grand total."""
    ev = fixtures.table(spark, sf_dir, "events")
    return report_query.run_report(
        ev, dimensions={"month": F.trunc("ts", "MM"), "ad_unit_name": "event_type"},
        metrics={"events": F.lit(1).cast("bigint")}, totals=True, reach="user_id")


def _stored_days(spark, sf_dir):
    """Daily sums and user sketches of all events, stored as a table."""
    ev = fixtures.table(spark, sf_dir, "events")
    days = reach.daily_reach(ev, F.to_date("ts"), {"ad_unit_name": "event_type"}, {"events": F.lit(1).cast("bigint")}, "user_id")
    name = f"reach_days_{uuid.uuid4().hex}"
    reach.store_days(spark, days, name, scratch_path(spark, "tables", "reach_days"))
    return spark.table(name)


def q_reach_from_days(spark, sf_dir):
    """Q-6 over months from stored days: no event is read again; an estimate."""
    return reach.reach_from_days(_stored_days(spark, sf_dir), {"month": F.trunc("date", "MM"), "ad_unit_name": "ad_unit_name"}, ["events"])


def q_reach_from_days_error(spark, sf_dir):
    """Q-6 from stored days against the exact count over all events: whether each month's
    estimate lies within five standard errors (and one user)."""
    ev = fixtures.table(spark, sf_dir, "events")
    found = reach.reach_from_days(_stored_days(spark, sf_dir), {"month": F.trunc("date", "MM")}, ["events"])
    exact = report_query.run_report(ev, {"month": F.trunc("ts", "MM")}, {"n": F.lit(1).cast("bigint")}, reach="user_id", reach_name="exact_reach")
    near = F.abs(F.col("unique_reach") - F.col("exact_reach")) <= 5 * reach.error() * F.col("exact_reach") + 1
    return found.join(exact, "month").select("month", "events", "exact_reach", near.alias("within_error"))


def _relative_report(spark, sf_dir, kind):
    """Inventory report over a range relative to "today", here the day after
    the latest shipment (one date reaches the driver), so that the bounds are
    literals: pushed to the scan, and row groups outside them are skipped."""
    li = fixtures.table(spark, sf_dir, "lineitem")
    latest = li.agg(F.max(F.to_date("l_shipdate"))).first()[0] or report_query.local_today()
    start, end = report_query.resolve_range(kind, today=latest + _dt.timedelta(days=1))
    return report_query.run_report(
        li,
        dimensions={"date": F.to_date("l_shipdate"), "ad_unit_name": "l_returnflag"},
        metrics={"ad_server_impressions": F.col("l_quantity").cast("bigint")},
        start=start, end=end, date_col="l_shipdate",
    )


def q_run_report_last_month(spark, sf_dir):
    """Q-2 LAST_MONTH + F-9: the month before "today"."""
    return _relative_report(spark, sf_dir, "LAST_MONTH")


def q_run_report_yesterday(spark, sf_dir):
    """Q-2 YESTERDAY + F-10: the day before "today"."""
    return _relative_report(spark, sf_dir, "YESTERDAY")


def q_local_yesterday(spark, sf_dir):
    """F-10: for every event (instants in UTC, many near midnight), the day
    before its calendar day in the report's time zone; events per such day."""
    ev = fixtures.table(spark, sf_dir, "events")
    day = dates.yesterday(F.col("ts").cast("timestamp_ntz"), registry.TIMEZONE)
    return ev.groupBy(day.alias("yesterday")).agg(F.count(F.lit(1)).alias("events"))


# Fixed value: scheme and query/fragment are not part of a page's hierarchy.
URL_PATH = r"^[a-z]+://([^?#]*)"


def q_hierarchy_levels(spark, sf_dir):
    """Q-3: site / section / page levels of each page's URL."""
    pg = fixtures.table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", URL_PATH, 1).alias("path"))
    return report_query.hierarchy_levels(pg, "path", levels=3, sep="/", prefix="level_") \
        .select("page_id", "level_1", "level_2", "level_3")


def q_hierarchy_rollup(spark, sf_dir):
    """A-1 + Q-3: pages and bytes of every site, section and page of the URL hierarchy.

    The extract holds rows at two levels: each page, and each site with the
    sums of its pages, which must not be counted again.
    """
    pg = fixtures.table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", URL_PATH, 1).alias("path"), F.lit(1).cast("bigint").alias("pages"), F.length("html").cast("bigint").alias("chars"))
    sites = report_query.run_report(pg, {"path": F.substring_index("path", "/", 1)}, ["pages", "chars"])
    return report_query.hierarchy_rollup(pg.unionByName(sites), "path", ["pages", "chars"])


# -- month chunks and backfill bookkeeping (G-1, A-8) --------------------------

def q_month_ranges(spark, sf_dir):
    """G-1 + F-9 + F-12: month chunks of each ad unit's delivery period."""
    li = fixtures.table(spark, sf_dir, "lineitem")
    bounds = li.groupBy(F.col("l_returnflag").alias("ad_unit_name")).agg(
        F.to_date(F.min("l_shipdate")).alias("start"), F.to_date(F.max("l_shipdate")).alias("end"))
    return calendar.explode_month_ranges(bounds, "start", "end", keep=("ad_unit_name",))


def q_backfill_summary(spark, sf_dir):
    """A-8: rows loaded per month chunk of a geo backfill, with the running total;
    chunks without rows show 0."""
    geo = reports.report_geo_backfill(_raw(spark, sf_dir, "geo_monthly"))
    orders = fixtures.table(spark, sf_dir, "orders")
    bounds = orders.agg(F.to_date(F.min("o_orderdate")).alias("start"),
                        F.to_date(F.max("o_orderdate")).alias("end"))
    chunks = calendar.explode_month_ranges(bounds, "start", "end")
    loaded = geo.groupBy(F.trunc("report_date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("rows_loaded"))
    # Both sides hold one row per month; AQE broadcasts the smaller at run time.
    joined = chunks.withColumn("month", F.trunc("month_start", "MM")).join(loaded, "month", "left")
    out = joined.select("chunk", "month_start", "month_end", "month_label",
                        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"))
    # The calendar has one row per month of the period: a bounded window.
    w = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumn("running_total", F.sum("rows_loaded").over(w))


# -- slice replacement and append, query form (U-1 … U-3, P-2, P-3) ------------

REPLACE_DAY = _dt.date(2024, 1, 15)
REPLACE_MONTHS = (_dt.date(1996, 3, 1), _dt.date(1996, 4, 1))
REPLACE_RANGE = (_dt.date(2024, 1, 10), _dt.date(2024, 1, 20))


def _changed_day(raw):
    """The day re-extracted without the ``error`` ad unit."""
    return reports.report_fill_rate(
        raw.where((F.col("DATE") == dates.date_to_int(F.lit(REPLACE_DAY))) & (F.col("AD_UNIT_NAME") != "error")))


def _changed_range(raw):
    """The range re-extracted, without one of its days."""
    lo, hi = REPLACE_RANGE
    day = dates.date_int_to_date(F.col("DATE"))
    return reports.report_fill_rate(raw.where(day.between(F.lit(lo), F.lit(hi)) & (day != F.lit(REPLACE_DAY))))


def q_replace_day(spark, sf_dir):
    """K-3 as a query: the day is re-extracted without the ``error`` ad unit."""
    raw = _raw(spark, sf_dir, "fill_rate")
    return setops.replace_slice(reports.report_fill_rate(raw), _changed_day(raw), "date", values=[REPLACE_DAY])


def q_replace_month(spark, sf_dir):
    """K-4 / K-6 as a query: a batch holding two months replaces both."""
    raw = _raw(spark, sf_dir, "geo_monthly")
    stored = reports.report_geo_monthly(raw)
    batch = reports.report_geo_backfill(raw).where(F.col("report_date").isin(*REPLACE_MONTHS))
    return setops.replace_slice(stored, batch, "report_date", values=REPLACE_MONTHS)


def q_replace_range(spark, sf_dir):
    """K-5 as a query: a day of the range without incoming rows ends up empty."""
    raw = _raw(spark, sf_dir, "fill_rate")
    return setops.replace_range(reports.report_fill_rate(raw), _changed_range(raw), "date", *REPLACE_RANGE)


def _half_months(raw):
    """A raw extract in two batches; rows without a date are in the second."""
    first = F.coalesce(F.dayofmonth(dates.date_int_to_date(F.col("DATE"))) <= 15, F.lit(False))
    return raw.where(first), raw.where(~first)


def q_append_union(spark, sf_dir):
    """U-1 / U-3: the fill-rate report loaded in half-month chunks, appended."""
    return setops.append_union(*map(reports.report_fill_rate, _half_months(_raw(spark, sf_dir, "fill_rate"))))


# -- audit (A-3 … A-7, A-9, L-3, L-4) --------------------------------------------

def _report_tables(spark, sf_dir):
    return {registry.REPORTS[n].table: reports.REPORT_PIPELINES[n](_raw(spark, sf_dir, n))
            for n in ("inventory_daily", "geo_monthly", "audience_interest",
                      "audience_demographics", "fill_rate")}


def q_audit_profile(spark, sf_dir):
    """A-3 + A-4 + A-5 for the five report tables, one row each."""
    return audit.audit_profiles({t: (df, registry.report(t).partition_col) for t, df in _report_tables(spark, sf_dir).items()})


def _dup_query(report):
    def q(spark, sf_dir):
        """A-6 + P-5: duplicate key groups of one report (all of them)."""
        df = reports.REPORT_PIPELINES[report](_raw(spark, sf_dir, report))
        return audit.audit_duplicates(df, registry.REPORTS[report].duplicate_key)
    q.__name__ = f"q_audit_duplicates_{report}"
    return q


def q_audit_duplicates_inventory_full_key(spark, sf_dir):
    """A-6 on the inventory key including the top ad-unit level (reported
    beside the audit's own key)."""
    df = q_report_inventory_daily(spark, sf_dir)
    return audit.audit_duplicates(df, registry.FULL_DUPLICATE_KEYS["inventory_daily"])


def q_audit_summary(spark, sf_dir):
    """A-7: row count per report table."""
    return audit.audit_summary(_report_tables(spark, sf_dir))


def q_top_duplicates(spark, sf_dir):
    """L-3: the five largest duplicate groups of the geography report (a top-k report)."""
    spec = registry.REPORTS["geo_monthly"]
    dups = audit.audit_duplicates(q_report_geo_monthly(spark, sf_dir), spec.duplicate_key)
    return audit.top_duplicates(dups, spec.duplicate_key, 5)


def q_report_sorted(spark, sf_dir):
    """L-2: the fill-rate report in the order of its keys."""
    return reports.present(q_report_fill_rate(spark, sf_dir), ("date", "ad_unit_name"))


def q_sample_rows(spark, sf_dir):
    """L-4: first three inventory rows by the full row (a sampling operator)."""
    df = q_report_inventory_daily(spark, sf_dir)
    return audit.sample_rows(df, registry.REPORTS["inventory_daily"].columns, 3)


def q_sample_values(spark, sf_dir):
    """A-9: ten smallest distinct ad-unit names."""
    return audit.sample_values(q_report_inventory_daily(spark, sf_dir), "ad_unit_name", 10)


# -- KPIs and categories (F-16 … F-19) -------------------------------------------

def q_kpi_fill_serve(spark, sf_dir):
    """F-16 + F-17: fill and serve rates in percent per day and ad unit."""
    fr = q_report_fill_rate(spark, sf_dir)
    return fr.select("date", "ad_unit_name",
                     kpi.fill_rate_percent().alias("fill_rate_percent"),
                     kpi.serve_rate_percent().alias("serve_rate_percent"))


def q_demographics_split(spark, sf_dir):
    """F-18: combined MALE_18_24 codes split into gender and age bracket."""
    raw = _raw(spark, sf_dir, "audience_demographics")
    return report_query.run_report(
        raw,
        dimensions={"report_date": dates.month_year_to_date("MONTH_YEAR"),
                    "gender": demographics.split_group_gender("GRP_DEMOGRAPHICS"),
                    "age_bracket": demographics.split_group_age("GRP_DEMOGRAPHICS")},
        metrics={"sessions": to_int64("SESSIONS"), "row_count": F.lit(1).cast("bigint")},
    )


def q_demographics_normalised(spark, sf_dir):
    """F-19: gender and age bracket mapped to their domains, then summed."""
    df = q_report_audience_demographics(spark, sf_dir)
    return report_query.run_report(
        df,
        dimensions={"report_date": "report_date",
                    "gender": demographics.normalise_gender("gender"),
                    "age_bracket": demographics.normalise_age("age_bracket")},
        metrics={"sessions": "sessions", "ga_impressions": "ga_impressions",
                 "active_users": "active_users", "row_count": F.lit(1).cast("bigint")},
    )


# -- coercion (F-4, F-5) -----------------------------------------------------------

def q_coerce_int(spark, sf_dir):
    """F-4 over every distinct impressions text of the inventory extract."""
    raw = _raw(spark, sf_dir, "inventory_daily")
    return raw.groupBy(F.col("IMPRESSIONS").alias("raw_text")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("value", to_int64("raw_text"))


def q_coerce_double(spark, sf_dir):
    """F-5 over every distinct rate text of the geo extract."""
    raw = _raw(spark, sf_dir, "geo_monthly")
    return raw.groupBy(F.col("AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE").alias("raw_text")) \
        .agg(F.count(F.lit(1)).alias("n")).withColumn("value", to_float64("raw_text"))


def q_coerce_int_text(spark, sf_dir):
    """F-4 over texts with suffixes, hex digits, exponents, blanks, names of
    special values, fractions and integers beyond 2**53."""
    return fixtures.numeric_texts(spark, sf_dir).withColumn("value", to_int64("raw_text"))


def q_coerce_double_text(spark, sf_dir):
    """F-5 over the same texts."""
    return fixtures.numeric_texts(spark, sf_dir).withColumn("value", to_float64("raw_text"))


# -- reconcile (C-7) ------------------------------------------------------------

def q_reconcile(spark, sf_dir):
    """Daily sums of the raw fill-rate rows against the deduplicated report."""
    raw = _raw(spark, sf_dir, "fill_rate")
    typed = reports.transform(raw, registry.REPORTS["fill_rate"])
    deduped = reports.report_fill_rate(raw)
    return reconcile.reconcile(typed, deduped, ["date"], list(registry.FILL_RATE_SUM_COLUMNS))


def q_reconcile_rows(spark, sf_dir):
    """C-7 row by row: the stored fill-rate report against one whose range was extracted again
    (one unit and one day less)."""
    raw = _raw(spark, sf_dir, "fill_rate")
    name = _loaded(spark, "fill_rate", reports.report_fill_rate(raw))
    again = setops.replace_slice(reports.report_fill_rate(raw), _changed_day(raw), "date", values=[REPLACE_DAY])
    gone = F.coalesce(F.col("date") == F.lit(REPLACE_RANGE[0]), F.lit(False))
    return reconcile.reconcile_rows(spark.table(name), again.where(~gone), "date")


# -- sources (S-1, S-2, S-4, G-2) ------------------------------------------------

FILL_RATE_DIMS = ("DATE", "AD_UNIT_NAME")
FILL_RATE_METRICS = ("UNFILLED_IMPRESSIONS", "CODE_SERVED_COUNT", "RESPONSES_SERVED",
                     "AD_SERVER_IMPRESSIONS", "FILL_RATE", "AD_REQUESTS")


def _landed_pages(spark, sf_dir, fmt):
    path = scratch_path(spark, "landing", "fill_rate_pages")
    raw = _raw(spark, sf_dir, "fill_rate")
    pages.pages_from_rows(raw, FILL_RATE_DIMS, FILL_RATE_METRICS).select("rows").write.format(fmt).save(path)
    flat = pages.flatten_pages(pages.read_pages(spark, path, fmt=fmt), FILL_RATE_DIMS, FILL_RATE_METRICS)
    return reports.report_fill_rate(flat)


def q_flatten_pages(spark, sf_dir):
    """S-1 + S-2 + G-2: the fill-rate extract landed as result pages (Parquet),
    read with the page schema, flattened back by header position, then run
    through the fill-rate pipeline."""
    return _landed_pages(spark, sf_dir, "parquet")


def q_flatten_json_pages(spark, sf_dir):
    """The same with JSON result pages."""
    return _landed_pages(spark, sf_dir, "json")


def inventory_csv_frame(raw):
    """The inventory extract laid out as a hierarchical CSV dump."""
    day = dates.date_int_to_date(F.col("DATE"))
    return raw.select(
        F.date_format(day, "yyyy-MM-dd").alias("Dimension.DATE"),
        F.col("AD_UNIT_NAME_TOP_LEVEL").alias("Ad unit 1"),
        F.col("AD_UNIT_NAME").alias("Ad unit 2"),
        F.col("ORDER_NAME").alias("Dimension.ORDER_NAME"),
        F.col("DEVICE_CATEGORY_NAME").alias("Dimension.DEVICE_CATEGORY_NAME"),
        F.col("RENDERED_CREATIVE_SIZE").alias("Dimension.CREATIVE_SIZE"),
        F.col("IMPRESSIONS").alias("Column.AD_SERVER_IMPRESSIONS"),
        F.col("CLICKS").alias("Column.AD_SERVER_CLICKS"),
        F.col("AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS")
        .alias("Column.AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS"),
        F.col("ACTIVE_VIEW_VIEWABLE_IMPRESSIONS").alias("Column.AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS"),
    )


def _land_csv(spark, frame, name, partition_by=None):
    """The extract ``frame`` landed as CSV dumps under the shared folder, read
    back as text (plus the partition column, when the landing is split by it).
    In production the dumps already exist; here each call lands them anew from
    the test tables, so a result never comes from an earlier state of them.
    """
    path = scratch_path(spark, "landing", name)
    csv_dump.write_csv_dump(frame, path, partition_by)
    cols = [c for c in frame.columns if c != partition_by]
    return csv_dump.read_csv_dump(spark, path, cols)


def q_csv_dump(spark, sf_dir):
    """S-4: the inventory extract landed as a CSV dump in the shared folder,
    read back as text and typed by the backfill pipeline."""
    frame = inventory_csv_frame(_raw(spark, sf_dir, "inventory_daily"))
    return reports.csv_inventory_daily(_land_csv(spark, frame, "inventory_csv"))


def q_csv_dump_mixed_headers(spark, sf_dir):
    """S-4: dumps of two report versions in one landing, their columns in
    different order; columns are found by header name."""
    path = scratch_path(spark, "landing", "mixed_csv")
    frame = inventory_csv_frame(_raw(spark, sf_dir, "inventory_daily"))
    early = F.coalesce(F.col("`Dimension.DATE`") < "1995-01-01", F.lit(False))
    csv_dump.write_csv_dump(frame.where(early), f"{path}/v1")
    csv_dump.write_csv_dump(frame.where(~early).select(*[F.col(f"`{c}`") for c in reversed(frame.columns)]), f"{path}/v2")
    return reports.csv_inventory_daily(csv_dump.read_csv_dump(spark, f"{path}/*", frame.columns))


def q_csv_dump_fill_rate(spark, sf_dir):
    """S-4 + J-3: fill-rate dumps with hierarchical ad-unit columns, typed and
    deduplicated by the backfill pipeline."""
    raw = _raw(spark, sf_dir, "fill_rate")
    frame = raw.select(
        F.date_format(dates.date_int_to_date(F.col("DATE")), "yyyy-MM-dd").alias("Dimension.DATE"),
        F.substring("AD_UNIT_NAME", 1, 1).alias("Ad unit 1"),
        F.col("AD_UNIT_NAME").alias("Ad unit 2"),
        F.col("UNFILLED_IMPRESSIONS").alias("Column.TOTAL_INVENTORY_LEVEL_UNFILLED_IMPRESSIONS"),
        F.col("CODE_SERVED_COUNT").alias("Column.TOTAL_CODE_SERVED_COUNT"),
        F.col("RESPONSES_SERVED").alias("Column.TOTAL_RESPONSES_SERVED"),
        F.col("AD_SERVER_IMPRESSIONS").alias("Column.AD_SERVER_IMPRESSIONS"),
        F.col("FILL_RATE").alias("Column.TOTAL_FILL_RATE"),
        F.col("AD_REQUESTS").alias("Column.TOTAL_AD_REQUESTS"),
    )
    return reports.csv_fill_rate(_land_csv(spark, frame, "fill_rate_csv"))


def _geo_month_frame(raw, legacy=False):
    month = dates.month_year_to_date(F.col("MONTH_YEAR"))
    cols = [F.col("COUNTRY_NAME").alias("Dimension.COUNTRY_NAME"),
            F.col("COUNTRY_CODE").alias("Dimension.COUNTRY_CRITERIA_ID"),
            F.col("IMPRESSIONS").alias("Column.AD_SERVER_IMPRESSIONS"),
            F.col("CLICKS").alias("Column.AD_SERVER_CLICKS")]
    if not legacy:
        cols += [F.col("AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE")
                 .alias("Column.AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE"),
                 F.col("AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS")
                 .alias("Column.AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS")]
    return raw.select(*cols, F.date_format(month, "yyyy-MM-dd").alias("chunk_start"))


def q_csv_dump_geo(spark, sf_dir):
    """S-4 + J-5 + P-1: geo dumps landed one folder per month chunk; each
    row's report_date is its chunk's first day (from the folder name)."""
    landed = _land_csv(spark, _geo_month_frame(_raw(spark, sf_dir, "geo_monthly")), "geo_csv",
                       "chunk_start")
    return reports.csv_geo_monthly(landed, F.col("chunk_start").cast("string").cast("date"))


def _legacy_inventory_frame(raw):
    return raw.select(
        F.date_format(dates.date_int_to_date(F.col("DATE")), "yyyy-MM-dd").alias("Dimension.DATE"),
        F.regexp_extract("AD_UNIT_NAME", "[0-9]+", 0).alias("Dimension.AD_UNIT_ID"),
        F.col("AD_UNIT_NAME").alias("Dimension.AD_UNIT_NAME"),
        F.regexp_extract("ORDER_NAME", "[0-9]+", 0).alias("Dimension.ORDER_ID"),
        F.col("ORDER_NAME").alias("Dimension.ORDER_NAME"),
        F.col("DEVICE_CATEGORY_NAME").alias("Dimension.DEVICE_CATEGORY_NAME"),
        F.col("RENDERED_CREATIVE_SIZE").alias("Dimension.CREATIVE_SIZE"),
        F.col("IMPRESSIONS").alias("Column.AD_SERVER_IMPRESSIONS"),
        F.col("CLICKS").alias("Column.AD_SERVER_CLICKS"),
    )


def q_legacy_inventory_daily(spark, sf_dir):
    """Legacy inventory dump (ids, no Active View columns kept when absent)."""
    frame = _legacy_inventory_frame(_raw(spark, sf_dir, "inventory_daily"))
    return reports.legacy_inventory_daily(_land_csv(spark, frame, "legacy_inventory_csv"))


def q_legacy_geo_monthly(spark, sf_dir):
    """Legacy geo dump: country ids, NULL-name subtotals kept, month from the chunk."""
    frame = _geo_month_frame(_raw(spark, sf_dir, "geo_monthly"), legacy=True)
    landed = _land_csv(spark, frame, "legacy_geo_csv", "chunk_start")
    return reports.legacy_geo_monthly(landed, F.col("chunk_start").cast("string").cast("date"))


# -- loads, read back from their tables (K-1 … K-13, C-1, C-3, C-5, C-6, S-5, S-8) --

def _empty_table(spark, report, versioned=True):
    """A new report table under the checkpoint folder."""
    spec = registry.report(report)
    name = f"{spec.table}_{uuid.uuid4().hex}"
    return tables.ensure_table(spark, spec, name, location=scratch_path(spark, "tables", spec.table), versioned=versioned)


def _loaded(spark, report, batch, versioned=True, **kwargs):
    name = _empty_table(spark, report, versioned)
    jobs.load(spark, report, batch, table=name, log_table=None, **kwargs)
    return name


def q_load_append(spark, sf_dir):
    """K-1 + K-7 + K-9 + C-1: two batches appended to a new table."""
    first, second = map(reports.report_fill_rate, _half_months(_raw(spark, sf_dir, "fill_rate")))
    name = _loaded(spark, "fill_rate", first, mode="append")
    jobs.load(spark, "fill_rate", second, mode="append", table=name, log_table=None)
    return spark.table(name)


def q_load_overwrite(spark, sf_dir):
    """K-2: a table overwritten as a whole by two of its months."""
    geo = reports.report_geo_backfill(_raw(spark, sf_dir, "geo_monthly"))
    name = _loaded(spark, "geo_monthly", geo)
    jobs.load(spark, "geo_monthly", geo.where(F.col("report_date").isin(*REPLACE_MONTHS)), mode="overwrite", table=name, log_table=None)
    return spark.table(name)


def q_load_replace_day(spark, sf_dir):
    """K-3: one day of a stored table replaced."""
    raw = _raw(spark, sf_dir, "fill_rate")
    name = _loaded(spark, "fill_rate", reports.report_fill_rate(raw))
    jobs.load(spark, "fill_rate", _changed_day(raw), table=name, log_table=None)
    return spark.table(name)


def q_load_replace_month(spark, sf_dir):
    """K-4 / K-6: two months of a stored table replaced by a batch with doubled clicks."""
    geo = reports.report_geo_backfill(_raw(spark, sf_dir, "geo_monthly"))
    name = _loaded(spark, "geo_monthly", geo)
    batch = geo.where(F.col("report_date").isin(*REPLACE_MONTHS)).withColumn("ad_server_clicks", F.col("ad_server_clicks") * 2)
    jobs.load(spark, "geo_monthly", batch, table=name, log_table=None)
    return spark.table(name)


def q_load_replace_range(spark, sf_dir):
    """K-5: a range of a stored table replaced; its day without rows ends up empty."""
    raw = _raw(spark, sf_dir, "fill_rate")
    name = _loaded(spark, "fill_rate", reports.report_fill_rate(raw))
    jobs.load(spark, "fill_rate", _changed_range(raw), mode="range", start=REPLACE_RANGE[0], end=REPLACE_RANGE[1], table=name, log_table=None)
    return spark.table(name)


def q_load_empty(spark, sf_dir):
    """K-10: loads of an empty batch change nothing, in any mode."""
    batch = q_report_fill_rate(spark, sf_dir)
    name = _loaded(spark, "fill_rate", batch)
    for mode in ("slice", "append", "overwrite", "range"):
        jobs.load(spark, "fill_rate", batch.where("false"), mode=mode, start=REPLACE_RANGE[0], end=REPLACE_RANGE[1], table=name, log_table=None)
    return spark.table(name)


def q_load_dry_run(spark, sf_dir):
    """K-11: the slices that a load would change, with both sides' sums."""
    raw = _raw(spark, sf_dir, "fill_rate")
    name = _loaded(spark, "fill_rate", reports.report_fill_rate(raw))
    return jobs.load(spark, "fill_rate", setops.append_union(_changed_day(raw), _changed_range(raw)), table=name, dry_run=True)["diff"]


def q_load_log(spark, sf_dir):
    """K-12 + K-13: the log of a load, a range load and an empty load."""
    raw, log = _raw(spark, sf_dir, "fill_rate"), f"load_log_{uuid.uuid4().hex}"
    name = _empty_table(spark, "fill_rate")
    whole = reports.report_fill_rate(raw)
    jobs.load(spark, "fill_rate", whole, table=name, log_table=log)
    jobs.load(spark, "fill_rate", _changed_range(raw), mode="range", start=REPLACE_RANGE[0], end=REPLACE_RANGE[1], table=name, log_table=log)
    jobs.load(spark, "fill_rate", whole.where("false"), table=name, log_table=log)
    return spark.table(log).select("severity", "report_type", "mode", "slice_start", "slice_end", "rows_written", "null_metric_values", "status", "message")


def _copies(spark, counted, piece=100_000):
    """``n`` rows of each row, numbered in ``copy`` from 1, made in as many tasks as a shuffle has."""
    pieces = counted.withColumn("piece", F.explode(F.expr(f"sequence(0L, (n - 1) div {piece})")))
    dealt = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *pieces.columns)
    return dealt.withColumn("copy", F.explode(F.expr(f"sequence(piece * {piece} + 1, least(n, (piece + 1) * {piece}))"))).drop("piece")


def q_load_log_coerced(spark, sf_dir):
    """K-13 + X20: per column, how many values of an extract were there and became NULL: an
    inventory extract whose impressions are the number-like texts of every line, one day long."""
    texts = fixtures.numeric_texts(spark, sf_dir)
    rows = _copies(spark, texts)
    raw = rows.select(
        F.lit(20240115).cast("bigint").alias("DATE"), F.lit("top").alias("AD_UNIT_NAME_TOP_LEVEL"), F.lit("unit").alias("AD_UNIT_NAME"),
        F.lit("order").alias("ORDER_NAME"), F.lit("Desktop").alias("DEVICE_CATEGORY_NAME"), F.lit("1x1").alias("RENDERED_CREATIVE_SIZE"),
        F.col("raw_text").alias("IMPRESSIONS"), F.col("copy").cast("string").alias("CLICKS"),
        F.lit("-").alias("AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS"), F.lit(None).cast("string").alias("ACTIVE_VIEW_VIEWABLE_IMPRESSIONS"))
    log, coerced, fetched = f"load_log_{uuid.uuid4().hex}", Observation("coerced_inventory"), Observation("fetched_inventory")
    raw = raw.observe(fetched, F.count(F.lit(1)).alias("rows"))
    jobs.load(spark, "inventory_daily", reports.report_inventory_daily(raw, coerced=coerced), table=_empty_table(spark, "inventory_daily"),
              log_table=log, extra_columns="drop", coerced=coerced, fetched=fetched)
    return spark.table(log).select("report_type", "rows_read", "rows_written", "coerced_to_null", F.explode("coerced_by_column").alias("column_name", "column_coerced"))


# A backfill from mid-month to mid-month whose extract lacks the month between.
BACKFILL = (_dt.date(1996, 1, 15), _dt.date(1996, 3, 10))


def _backfilled(spark, sf_dir, chunked):
    raw = _raw(spark, sf_dir, "geo_monthly")
    name = _loaded(spark, "geo_monthly", reports.report_geo_backfill(raw))
    month = dates.month_year_to_date(F.col("MONTH_YEAR"))
    restated = raw.where(~F.coalesce(month == F.lit(_dt.date(1996, 2, 1)), F.lit(False))).withColumn("CLICKS", F.col("CLICKS") + 100)
    jobs.backfill(spark, "geo_monthly", restated, *BACKFILL, chunked=chunked, table=name, pipeline=reports.report_geo_backfill, log_table=None)
    return spark.table(name)


def q_job_backfill(spark, sf_dir):
    """C-3 + K-10: a range backfilled in one job; its month without rows stays as stored."""
    return _backfilled(spark, sf_dir, False)


def q_job_backfill_chunked(spark, sf_dir):
    """C-3: the same range in month chunks gives the same table."""
    return _backfilled(spark, sf_dir, True)


RESUMED = (_dt.date(1996, 1, 15), _dt.date(1996, 5, 10))


def q_job_backfill_resumed(spark, sf_dir):
    """C-3: a chunked backfill run again with one of its months changed: the other months are skipped."""
    raw = _raw(spark, sf_dir, "geo_monthly")
    month = dates.month_year_to_date(F.col("MONTH_YEAR"))
    changed = raw.withColumn("CLICKS", F.when(month == F.lit(REPLACE_MONTHS[0]), F.col("CLICKS") + 1).otherwise(F.col("CLICKS")))
    name, ledger = _empty_table(spark, "geo_monthly"), f"backfill_ledger_{uuid.uuid4().hex}"
    for extract in (raw, changed):
        done = jobs.backfill(spark, "geo_monthly", extract, *RESUMED, table=name, ledger=ledger, pipeline=reports.report_geo_backfill, log_table=None)
    per_chunk = spark.createDataFrame([(c["month_label"], c["start"], c["status"], c["rows"]) for c in done["chunks"]],
                                      "month_label string, start date, status string, rows long")
    clicks = spark.table(name).groupBy(F.greatest("report_date", F.lit(RESUMED[0])).alias("start")).agg(F.sum("ad_server_clicks").alias("clicks"))
    return per_chunk.join(clicks, "start", "left").select("month_label", "status", "rows", "clicks")


def _whole_period(landed):
    """First and last day of the months that a landing's folders name: two dates."""
    month = F.col("chunk_start").cast("string").cast("date")
    return tuple(landed.agg(F.min(month), F.last_day(F.max(month))).first())


def q_job_backfill_geo_csv(spark, sf_dir):
    """C-3 + J-5: a geography table backfilled from CSV dumps landed by month."""
    landed = _land_csv(spark, _geo_month_frame(_raw(spark, sf_dir, "geo_monthly")), "geo_csv", "chunk_start")
    name = _empty_table(spark, "geo_monthly")
    jobs.backfill(spark, "geo_monthly", landed, *_whole_period(landed), table=name, pipeline=reports.csv_geo_monthly, log_table=None)
    return spark.table(name)


def q_job_backfill_legacy(spark, sf_dir):
    """C-3: a legacy geography table (ids, no Active View) backfilled from its dumps."""
    landed = _land_csv(spark, _geo_month_frame(_raw(spark, sf_dir, "geo_monthly"), legacy=True), "legacy_geo_csv", "chunk_start")
    name = _empty_table(spark, "legacy_geo_monthly")
    jobs.backfill(spark, "legacy_geo_monthly", landed, *_whole_period(landed), table=name, log_table=None)
    return spark.table(name)


def q_job_audit(spark, sf_dir):
    """C-5: the findings of a stored report table (their texts aside)."""
    name = _loaded(spark, "geo_monthly", reports.report_geo_backfill(_raw(spark, sf_dir, "geo_monthly")))
    return jobs.audit(spark, "geo_monthly", spark.table(name))


def q_job_audit_incremental(spark, sf_dir):
    """C-5 + A-6 slice by slice: a stored table audited, two of its months replaced, and audited
    again from the stored findings of the months that did not change."""
    geo = reports.report_geo_backfill(_raw(spark, sf_dir, "geo_monthly"))
    name, store = _loaded(spark, "geo_monthly", geo), f"audit_slices_{uuid.uuid4().hex}"
    jobs.audit_incremental(spark, "geo_monthly", store, spark.table(name))
    changed = geo.where(F.col("report_date").isin(*REPLACE_MONTHS) & (F.col("ad_server_clicks") % 2 == 0))
    jobs.load(spark, "geo_monthly", changed, table=name, log_table=None)
    return jobs.audit_incremental(spark, "geo_monthly", store, spark.table(name))


def q_audit_profile_stored(spark, sf_dir):
    """A-3 + A-4 + A-5 + A-7 of stored tables from partition values and file footers alone."""
    batches = {"fill_rate": q_report_fill_rate(spark, sf_dir), "geo_monthly": reports.report_geo_backfill(_raw(spark, sf_dir, "geo_monthly"))}
    return audit.audit_profiles({r: (spark.table(_loaded(spark, r, df)), registry.report(r).partition_col) for r, df in batches.items()})


def q_job_audit_all(spark, sf_dir):
    """C-6 + A-7: two stored tables and a missing one; the missing one is reported, the others are audited."""
    views = {"fill_rate_audited": ("fill_rate", q_report_fill_rate(spark, sf_dir)),
             "geo_audited": ("geo_monthly", reports.report_geo_backfill(_raw(spark, sf_dir, "geo_monthly")))}
    frames = {view: (report, spark.table(_loaded(spark, report, df))) for view, (report, df) in views.items()}
    found = jobs.audit_all(spark, ["no_such_table", *frames], frames)
    return found.where("check <> 'error'").unionByName(found.where("check = 'error'").withColumn("detail", F.lit("missing")))


def q_table_scan(spark, sf_dir):
    """S-8: a stored table read by its folder, one day range pruned to its partitions."""
    batch = q_report_fill_rate(spark, sf_dir)
    name = _loaded(spark, "fill_rate", batch, versioned=False)
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    rows = source_tables.read_report(spark, "fill_rate", path=where)
    return rows.where(F.col("date").between(*map(F.lit, REPLACE_RANGE)))


def q_ad_hoc_sql(spark, sf_dir):
    """S-5: SQL over a report given by name."""
    return source_tables.query(
        spark, "select ad_unit_name, sum(ad_requests) as ad_requests, count(distinct date) as days from {fill_rate} group by ad_unit_name",
        fill_rate=q_report_fill_rate(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "report_fill_rate": q_report_fill_rate,
    "report_inventory_daily": q_report_inventory_daily,
    "report_geo_monthly": q_report_geo_monthly,
    "report_geo_backfill": q_report_geo_backfill,
    "report_audience_interest": q_report_audience_interest,
    "report_audience_demographics": q_report_audience_demographics,
    "run_report_inventory": q_run_report_inventory,
    "run_report_totals": q_run_report_totals,
    "run_report_reach": q_run_report_reach,
    "run_report_reach_totals": q_run_report_reach_totals,
    "reach_from_days": q_reach_from_days,
    "reach_from_days_error": q_reach_from_days_error,
    "run_report_last_month": q_run_report_last_month,
    "run_report_yesterday": q_run_report_yesterday,
    "local_yesterday": q_local_yesterday,
    "hierarchy_levels": q_hierarchy_levels,
    "hierarchy_rollup": q_hierarchy_rollup,
    "month_ranges": q_month_ranges,
    "backfill_summary": q_backfill_summary,
    "replace_day": q_replace_day,
    "replace_month": q_replace_month,
    "replace_range": q_replace_range,
    "append_union": q_append_union,
    "audit_profile": q_audit_profile,
    **{f"audit_duplicates_{r}": _dup_query(r) for r in registry.REPORTS},
    "audit_duplicates_inventory_full_key": q_audit_duplicates_inventory_full_key,
    "audit_summary": q_audit_summary,
    "top_duplicates": q_top_duplicates,
    "report_sorted": q_report_sorted,
    "sample_rows": q_sample_rows,
    "sample_values": q_sample_values,
    "kpi_fill_serve": q_kpi_fill_serve,
    "demographics_split": q_demographics_split,
    "demographics_normalised": q_demographics_normalised,
    "coerce_int": q_coerce_int,
    "coerce_double": q_coerce_double,
    "coerce_int_text": q_coerce_int_text,
    "coerce_double_text": q_coerce_double_text,
    "reconcile": q_reconcile,
    "reconcile_rows": q_reconcile_rows,
    "flatten_pages": q_flatten_pages,
    "flatten_json_pages": q_flatten_json_pages,
    "csv_dump": q_csv_dump,
    "csv_dump_mixed_headers": q_csv_dump_mixed_headers,
    "csv_dump_fill_rate": q_csv_dump_fill_rate,
    "csv_dump_geo": q_csv_dump_geo,
    "legacy_inventory_daily": q_legacy_inventory_daily,
    "legacy_geo_monthly": q_legacy_geo_monthly,
    "load_append": q_load_append,
    "load_overwrite": q_load_overwrite,
    "load_replace_day": q_load_replace_day,
    "load_replace_month": q_load_replace_month,
    "load_replace_range": q_load_replace_range,
    "load_empty": q_load_empty,
    "load_dry_run": q_load_dry_run,
    "load_log": q_load_log,
    "load_log_coerced": q_load_log_coerced,
    "job_backfill": q_job_backfill,
    "job_backfill_chunked": q_job_backfill_chunked,
    "job_backfill_geo_csv": q_job_backfill_geo_csv,
    "job_backfill_legacy": q_job_backfill_legacy,
    "job_backfill_resumed": q_job_backfill_resumed,
    "job_audit": q_job_audit,
    "job_audit_incremental": q_job_audit_incremental,
    "audit_profile_stored": q_audit_profile_stored,
    "job_audit_all": q_job_audit_all,
    "table_scan": q_table_scan,
    "ad_hoc_sql": q_ad_hoc_sql,
}
