"""Oracle SQL: for each named query, DuckDB SQL over the raw test tables.

Written independently of the Spark code (plain SQL over the raw extract), so
a mismatch points at a real semantic difference.  Dialect notes: DuckDB's
``sum(bigint)`` is HUGEINT (cast back), ``1/0`` is inf (``nullif``), ``%``
truncates toward zero (used only on non-negative keys), NULLs sort last
unless told otherwise.
"""

from __future__ import annotations

from ..sources.fixtures import NUMERIC_SQL, raw_sql


def _date_int(x: str) -> str:
    return (f"make_date(cast(floor({x} / 10000) as bigint), "
            f"cast(floor(({x} % 10000) / 100) as bigint), cast({x} % 100 as bigint))")


def _month_year(x: str) -> str:
    m = f"((({x}) % 100 + 100) % 100)"
    return (f"make_date(cast(2010 + floor(({x}) / 100) + floor({m} / 12) as bigint), "
            f"cast({m} % 12 + 1 as bigint), 1)")


def _int64(x: str) -> str:
    d = f"try_cast({x} as double)"
    return f"(case when {d} = floor({d}) then cast({d} as bigint) end)"


def _float64(x: str) -> str:
    d = f"try_cast({x} as double)"
    return f"(case when isnan({d}) then null else {d} end)"


# A decimal number in plain or exponent notation, else NULL.
_PLAIN = r"(case when regexp_full_match(trim(raw_text), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') then trim(raw_text) end)"


def _sum(x: str) -> str:
    return f"cast(coalesce(sum({x}), 0) as bigint)"


def _with(**ctes: str) -> str:
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in ctes.items()) + "\n"


RAW = {name: raw_sql(name) for name in (
    "fill_rate", "inventory_daily", "geo_monthly", "audience_interest", "audience_demographics")}

# -- typed report rows ---------------------------------------------------------

def fill_rate_typed(src: str = "raw_fill_rate", where: str = "") -> str:
    return f"""
select {_date_int('DATE')} as date, cast(AD_UNIT_NAME as varchar) as ad_unit_name,
       UNFILLED_IMPRESSIONS as unfilled_impressions, CODE_SERVED_COUNT as code_served_count,
       RESPONSES_SERVED as responses_served, AD_SERVER_IMPRESSIONS as ad_server_impressions,
       AD_REQUESTS as ad_requests
from {src} {where}"""


def fill_rate(src: str = "fill_rate_typed", where: str = "") -> str:
    return f"""
select date, ad_unit_name,
       {_sum('unfilled_impressions')} as unfilled_impressions,
       {_sum('code_served_count')} as code_served_count,
       {_sum('responses_served')} as responses_served,
       {_sum('ad_server_impressions')} as ad_server_impressions,
       cast({_sum('ad_server_impressions')} as double) / nullif({_sum('ad_requests')}, 0) as fill_rate,
       {_sum('ad_requests')} as ad_requests
from {src} {where}
group by date, ad_unit_name"""


FILL_RATE_TYPED = fill_rate_typed()
FILL_RATE = fill_rate()

INVENTORY = f"""
select {_date_int('DATE')} as date, AD_UNIT_NAME_TOP_LEVEL as ad_unit_top_level,
       AD_UNIT_NAME as ad_unit_name, ORDER_NAME as order_name,
       DEVICE_CATEGORY_NAME as device_category, RENDERED_CREATIVE_SIZE as creative_size,
       {_int64('IMPRESSIONS')} as ad_server_impressions,
       {_int64('CLICKS')} as ad_server_clicks,
       {_int64('AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS')} as active_view_measurable_impressions,
       {_int64('ACTIVE_VIEW_VIEWABLE_IMPRESSIONS')} as active_view_viewable_impressions
from raw_inventory_daily"""

GEO = f"""
select cast(COUNTRY_NAME as varchar) as country_name, cast(COUNTRY_CODE as varchar) as country_code,
       {_month_year('MONTH_YEAR')} as report_date,
       IMPRESSIONS as ad_server_impressions, CLICKS as ad_server_clicks,
       {_float64('AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE')} as active_view_measurable_rate,
       AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS as active_view_viewable_impressions
from raw_geo_monthly"""

INTEREST = f"""
select {_month_year('MONTH_YEAR')} as report_date, cast(INTEREST as varchar) as interest_category,
       SESSIONS as sessions, GOOGLE_ANALYTICS_IMPRESSIONS as ga_impressions,
       {_float64('BOUNCE_RATE')} as bounce_rate, {_float64('ENGAGEMENT_RATE')} as engagement_rate,
       ACTIVE_USERS as active_users, GOOGLE_ANALYTICS_VIEWS as ga_views,
       {_float64('GOOGLE_ANALYTICS_VIEWS_PER_USER')} as ga_views_per_user, AD_VIEWERS as ad_viewers
from raw_audience_interest"""

DEMOGRAPHICS = f"""
select {_month_year('MONTH_YEAR')} as report_date, GRP_DEMOGRAPHICS,
       cast(GENDER_NAME as varchar) as gender, cast(AGE_BRACKET_NAME as varchar) as age_bracket,
       SESSIONS as sessions, GOOGLE_ANALYTICS_IMPRESSIONS as ga_impressions,
       {_float64('BOUNCE_RATE')} as bounce_rate,
       ACTIVE_USERS as active_users, GOOGLE_ANALYTICS_VIEWS as ga_views,
       {_float64('GOOGLE_ANALYTICS_VIEWS_PER_USER')} as ga_views_per_user, AD_VIEWERS as ad_viewers
from raw_audience_demographics"""

_FR = dict(raw_fill_rate=RAW["fill_rate"], fill_rate_typed=FILL_RATE_TYPED)

_INV = dict(raw_inventory_daily=RAW["inventory_daily"], inventory=INVENTORY)
_GEO = dict(raw_geo_monthly=RAW["geo_monthly"], geo=GEO)
_INT = dict(raw_audience_interest=RAW["audience_interest"], interest=INTEREST)
_DEM = dict(raw_audience_demographics=RAW["audience_demographics"], demographics=DEMOGRAPHICS)
_ALL = dict(**_FR, fill_rate=FILL_RATE, **_INV, **_GEO, **_INT, **_DEM)

# report tables: (table name, CTE, date column, duplicate key)
_TABLES = [
    ("inventory_daily", "inventory", "date",
     "date, ad_unit_name, order_name, device_category, creative_size"),
    ("geo_monthly", "geo", "report_date", "report_date, country_code"),
    ("report_audience_interest", "interest", "report_date", "report_date, interest_category"),
    ("report_audience_demographics", "demographics", "report_date", "report_date, gender, age_bracket"),
    ("report_fill_rate", "fill_rate", "date", "date, ad_unit_name"),
]
_DUP_CTE = {"inventory_daily": "inventory", "geo_monthly": "geo", "audience_interest": "interest",
            "audience_demographics": "demographics", "fill_rate": "fill_rate"}
_DUP_KEY = {t[1]: t[3] for t in _TABLES}

def _months(bounds: str, keep: str = "") -> str:
    """Month chunks of each (s, e) row of ``bounds``."""
    k = f"{keep}, " if keep else ""
    part = f"partition by {keep} " if keep else ""
    return f"""
select {k}cast(row_number() over ({part}order by m) as integer) as chunk,
       greatest(m, s) as month_start, least(last_day(m), e) as month_end,
       strftime(m, '%B %Y') as month_label, m
from (select {k}s, e, cast(unnest(generate_series(cast(date_trunc('month', s) as timestamp),
                                                   cast(e as timestamp), interval 1 month)) as date) as m
      from {bounds})"""


_INV_COLS = ("date", "ad_unit_top_level", "ad_unit_name", "order_name", "device_category", "creative_size",
             "ad_server_impressions", "ad_server_clicks", "active_view_measurable_impressions",
             "active_view_viewable_impressions")

_RECONCILE_METRICS = ("unfilled_impressions", "code_served_count", "responses_served",
                      "ad_server_impressions", "ad_requests")


def _reconcile() -> str:
    def sums(suffix):
        return ", ".join(f"{_sum(m)} as {m}_{suffix}" for m in _RECONCILE_METRICS)
    cols = ", ".join(f"coalesce(a.{m}_a, 0) as {m}_a, coalesce(b.{m}_b, 0) as {m}_b, "
                     f"coalesce(a.{m}_a, 0) - coalesce(b.{m}_b, 0) as {m}_delta"
                     for m in _RECONCILE_METRICS)
    same = " and ".join(f"a.{m}_a = b.{m}_b" for m in _RECONCILE_METRICS)
    return (_with(**_FR, fill_rate=FILL_RATE,
                  a=f"select date, {sums('a')} from fill_rate_typed group by date",
                  b=f"select date, {sums('b')} from fill_rate group by date")
            + f"""select coalesce(a.date, b.date) as date, {cols},
       case when b.date is null then 'only_a' when a.date is null then 'only_b'
            when {same} then 'match' else 'mismatch' end as status
from a full outer join b on a.date = b.date""")


_GENDER_SQL = ("case when upper(trim(gender)) in ('HOMME', 'MALE') then 'Male' "
               "when upper(trim(gender)) in ('FEMME', 'FEMALE') then 'Female' else 'Unknown' end")
_AGE_SQL = ("case when trim(age_bracket) in ('18-24', '25-34', '35-44', '45-54', '55-64', '65+') "
            "then trim(age_bracket) else 'Unknown' end")
_GRP = "'^([A-Z]+)_(.*)$'"
_REPLACED_DAY = dict(stored=FILL_RATE, batch_typed=fill_rate_typed("raw_fill_rate", "where DATE = 20240115 and AD_UNIT_NAME <> 'error'"),
                     batch=fill_rate("batch_typed"))
_REPLACED_RANGE = dict(stored=FILL_RATE, batch=fill_rate(
    "fill_rate_typed", "where date between date '2024-01-10' and date '2024-01-20' and date <> date '2024-01-15'"))
_MONTHS_REPLACED = "report_date in (date '1996-03-01', date '1996-04-01')"
_GEO_COLS = ("report_date", "country_name", "country_code", "ad_server_impressions", "ad_server_clicks", "active_view_measurable_rate",
             "active_view_viewable_impressions")
_KEPT_GEO = dict(**_GEO, kept="select * from geo where country_name is not null")


def _geo_cols(clicks: str) -> str:
    return ", ".join(f"{clicks} as ad_server_clicks" if c == "ad_server_clicks" else c for c in _GEO_COLS)


_BACKFILLED = _with(**_KEPT_GEO) + f"""
select {_geo_cols("case when report_date in (date '1996-01-01', date '1996-03-01') then ad_server_clicks + 100 else ad_server_clicks end")} from kept"""


def _dry_run() -> str:
    """Per day of the batch, its sums against the stored report's, where they differ: the changed
    day's rows, and twice nothing else (the other days of the batch are as stored)."""
    def sums(suffix):
        return ", ".join(f"{_sum(m)} as {m}_{suffix}" for m in _RECONCILE_METRICS)
    cols = ", ".join(f"{m}_a, {m}_b, {m}_a - {m}_b as {m}_delta" for m in _RECONCILE_METRICS)
    return _with(**_FR, **_REPLACED_DAY, s=f"select date, {sums('a')} from stored group by date",
                 b=f"select date, {sums('b')} from batch group by date") + f"""
select b.date, {cols}, 'mismatch' as status from b join s on s.date = b.date
where {" or ".join(f"{m}_a <> {m}_b" for m in _RECONCILE_METRICS)}"""


def _nulls(src: str) -> str:
    return f"""(select count(*) filter (where unfilled_impressions is null) + count(*) filter (where code_served_count is null)
  + count(*) filter (where responses_served is null) + count(*) filter (where ad_server_impressions is null)
  + count(*) filter (where fill_rate is null) + count(*) filter (where ad_requests is null) from {src})"""


def _row_text(columns: str) -> str:
    return " || ', ' || ".join(f"'{c}=' || coalesce(cast({c} as varchar), 'NULL')" for c in columns.split(", "))


def _findings(name: str, src: str, date: str, key: str, columns: list[tuple[str, str]]) -> str:
    groups = f"(select {key}, count(*) as cnt from {src} group by {key} having count(*) > 1)"
    dups = f"(select count(*) from {groups})"
    largest = f"(select string_agg(t, '; ' order by cnt desc, t) from (select cnt, {_row_text(key + ', cnt')} as t from {groups} order by cnt desc, t limit 5))"
    first = f"(select * from {src} where {date} = (select min({date}) from {src}))"
    names = ", ".join(c for c, _ in columns)
    order = ", ".join(f"{c} asc nulls first" for c, _ in columns)
    sample = f"(select string_agg({_row_text(names)}, '; ' order by {order}) from (select * from {first} order by {order} limit 3))"
    coverage = f"(select cast(min({date}) as varchar) || ' .. ' || cast(max({date}) as varchar) || ' (' || count(distinct {date}) || ' distinct)' from {src})"
    stored = ", ".join(f"{c} {t}" for c, t in [x for x in columns if x[0] != date] + [x for x in columns if x[0] == date])
    checks = [("schema", "'INFO'", f"{len(columns)}", f"'{stored}'"), ("total_rows", "'INFO'", f"(select count(*) from {src})", "null"),
              ("date_range", "'INFO'", f"(select count(distinct {date}) from {src})", coverage),
              ("null_dates", f"(select case when count(*) = 0 then 'OK' else 'WARNING' end from {src} where {date} is null)",
               f"(select count(*) from {src} where {date} is null)", "null"),
              ("duplicates", f"case when {dups} = 0 then 'OK' else 'WARNING' end", dups, largest),
              ("sample", "'INFO'", f"(select least(3, count(*)) from {first})", sample)]
    return "\nunion all\n".join(
        f"select '{name}' as table_name, '{c}' as \"check\", {s} as status, cast({v} as bigint) as value, cast({d} as varchar) as detail" for c, s, v, d in checks)


_GEO_TYPES = [("report_date", "date"), ("country_name", "string"), ("country_code", "string"), ("ad_server_impressions", "bigint"), ("ad_server_clicks", "bigint"),
              ("active_view_measurable_rate", "double"), ("active_view_viewable_impressions", "bigint")]
_FILL_TYPES = [("date", "date"), ("ad_unit_name", "string"), ("unfilled_impressions", "bigint"), ("code_served_count", "bigint"), ("responses_served", "bigint"),
               ("ad_server_impressions", "bigint"), ("fill_rate", "double"), ("ad_requests", "bigint")]

ORACLES: dict[str, str] = {
    "report_fill_rate": _with(**_FR) + FILL_RATE,
    "report_inventory_daily": _with(raw_inventory_daily=RAW["inventory_daily"]) + INVENTORY,
    "report_geo_monthly": _with(raw_geo_monthly=RAW["geo_monthly"]) + GEO,
    "report_geo_backfill": _with(raw_geo_monthly=RAW["geo_monthly"], geo=GEO)
    + "select * from geo where country_name is not null",
    "report_audience_interest": _with(raw_audience_interest=RAW["audience_interest"]) + INTEREST,
    "report_audience_demographics": _with(raw_audience_demographics=RAW["audience_demographics"])
    + DEMOGRAPHICS,
    "run_report_inventory": """
select cast(l_shipdate as date) as date, l_returnflag as ad_unit_name, l_linestatus as device_category,
       cast(sum(cast(l_quantity as bigint)) as bigint) as ad_server_impressions,
       cast(sum(cast(l_linenumber as bigint)) as bigint) as ad_server_clicks
from lineitem
group by 1, 2, 3""",
    "run_report_totals": """
select ship_year, ad_unit_name, cast(sum(q) as bigint) as ad_server_impressions,
       cast(grouping(ship_year, ad_unit_name) as bigint) as grouping_level
from (select cast(year(l_shipdate) as integer) as ship_year, l_returnflag as ad_unit_name,
             cast(l_quantity as bigint) as q
      from lineitem)
group by rollup (ship_year, ad_unit_name)""",
    "run_report_reach": """
select cast(ts as date) as date, event_type as ad_unit_name, cast(count(*) as bigint) as events,
       count(distinct user_id) as unique_reach
from events
group by 1, 2""",
    "run_report_reach_totals": """
select month, ad_unit_name, cast(count(*) as bigint) as events, count(distinct user_id) as unique_reach,
       cast(grouping(month, ad_unit_name) as bigint) as grouping_level
from (select cast(date_trunc('month', ts) as date) as month, event_type as ad_unit_name, user_id from events)
group by rollup (month, ad_unit_name)""",
    "reach_from_days": """
select cast(date_trunc('month', ts) as date) as month, event_type as ad_unit_name, cast(count(*) as bigint) as events,
       count(distinct user_id) as unique_reach
from events group by 1, 2""",
    "reach_from_days_error": """
select cast(date_trunc('month', ts) as date) as month, cast(count(*) as bigint) as events, count(distinct user_id) as exact_reach,
       true as within_error
from events group by 1""",
    "hierarchy_rollup": r"""
with p as (select string_split(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/') as parts, length(html) as chars from pages),
n as (select parts, len(parts) as levels, 1 as pages, chars from p),
-- paths that stand above another one are repetitions of it, like the sites' own rows
u as (select array_to_string(parts, '/') as whole, parts, levels, sum(pages) as pages, sum(chars) as chars from n group by all),
above as (select distinct array_to_string(parts[1:k], '/') as path from (select parts, unnest(generate_series(1, levels - 1)) as k from u)),
low as (select * from u where whole not in (select path from above)),
e as (select array_to_string(parts[1:k], '/') as path, k, pages, chars from (select *, unnest(generate_series(1, levels)) as k from low))
select path, cast(k as integer) as level, cast(sum(pages) as bigint) as pages, cast(sum(chars) as bigint) as chars, count(*) as units
from e group by path, k""",
    "hierarchy_levels": """
select page_id, string_split(path, '/')[1] as level_1, string_split(path, '/')[2] as level_2,
       string_split(path, '/')[3] as level_3
from (select page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) as path from pages)""",
    "month_ranges": _with(b="select l_returnflag as ad_unit_name, cast(min(l_shipdate) as date) as s, "
                            "cast(max(l_shipdate) as date) as e from lineitem group by 1",
                          c=_months("b", "ad_unit_name"))
    + "select ad_unit_name, chunk, month_start, month_end, month_label from c",
    "backfill_summary": _with(**_GEO,
                              b="select cast(min(o_orderdate) as date) as s, "
                                "cast(max(o_orderdate) as date) as e from orders",
                              c=_months("b"),
                              l="select cast(date_trunc('month', report_date) as date) as month, "
                                "count(*) as rows_loaded from geo where country_name is not null group by 1")
    + """select chunk, month_start, month_end, month_label,
       cast(coalesce(l.rows_loaded, 0) as bigint) as rows_loaded,
       cast(sum(coalesce(l.rows_loaded, 0)) over (order by chunk rows between unbounded preceding
                                                  and current row) as bigint) as running_total
from c left join l on l.month = c.m""",
    "replace_day": _with(**_FR, stored=FILL_RATE,
                         batch_typed=fill_rate_typed(
                             "raw_fill_rate", "where DATE = 20240115 and AD_UNIT_NAME <> 'error'"),
                         batch=fill_rate("batch_typed"))
    + """select * from stored where not coalesce(date in (select date from batch), false)
union all select * from batch""",
    "replace_month": _with(**_GEO, batch="select * from geo where country_name is not null "
                                         "and report_date in (date '1996-03-01', date '1996-04-01')")
    + """select * from geo where not coalesce(report_date in (select report_date from batch), false)
union all select * from batch""",
    "replace_range": _with(**_FR, stored=FILL_RATE,
                           batch=fill_rate("fill_rate_typed",
                                           "where date between date '2024-01-10' and date '2024-01-20' "
                                           "and date <> date '2024-01-15'"))
    + """select * from stored
where not coalesce(date between date '2024-01-10' and date '2024-01-20', false)
union all select * from batch""",
    "append_union": _with(**_FR) + FILL_RATE,
    "audit_profile": _with(**_ALL) + "\nunion all\n".join(
        f"""select '{t}' as table_name, count(*) as total_rows,
       count(*) filter (where {d} is null) as null_dates, min({d}) as min_date, max({d}) as max_date,
       count(distinct {d}) as unique_dates from {c}""" for t, c, d, _ in _TABLES),
    **{f"audit_duplicates_{r}": _with(**_ALL)
       + f"select {_DUP_KEY[c]}, count(*) as cnt from {c} group by {_DUP_KEY[c]} having count(*) > 1"
       for r, c in _DUP_CTE.items()},
    "audit_summary": _with(**_ALL) + "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as row_count from {c}" for t, c, _, _ in _TABLES),
    "sample_rows": _with(**_INV) + "select * from inventory order by "
    + ", ".join(f"{c} asc nulls first" for c in _INV_COLS) + " limit 3",
    "sample_values": _with(**_INV)
    + "select distinct ad_unit_name from inventory order by ad_unit_name asc nulls first limit 10",
    "kpi_fill_serve": _with(**_FR, fill_rate=FILL_RATE) + """
select date, ad_unit_name,
       cast(ad_server_impressions as double) / nullif(ad_requests, 0) * 100.0 as fill_rate_percent,
       cast(code_served_count as double) / nullif(ad_requests, 0) * 100.0 as serve_rate_percent
from fill_rate""",
    "demographics_split": _with(raw_audience_demographics=RAW["audience_demographics"]) + f"""
select {_month_year('MONTH_YEAR')} as report_date,
       nullif(regexp_extract(GRP_DEMOGRAPHICS, {_GRP}, 1), '') as gender,
       regexp_replace(regexp_replace(nullif(regexp_extract(GRP_DEMOGRAPHICS, {_GRP}, 2), ''),
                                     '_PLUS$', '+'), '_', '-', 'g') as age_bracket,
       cast(sum({_int64('SESSIONS')}) as bigint) as sessions, cast(count(*) as bigint) as row_count
from raw_audience_demographics group by 1, 2, 3""",
    "demographics_normalised": _with(**_DEM) + f"""
select report_date, {_GENDER_SQL} as gender, {_AGE_SQL} as age_bracket,
       cast(sum(sessions) as bigint) as sessions, cast(sum(ga_impressions) as bigint) as ga_impressions,
       cast(sum(active_users) as bigint) as active_users, cast(count(*) as bigint) as row_count
from demographics group by 1, 2, 3""",
    "coerce_int": _with(raw_inventory_daily=RAW["inventory_daily"]) + f"""
select IMPRESSIONS as raw_text, count(*) as n, {_int64('IMPRESSIONS')} as value
from raw_inventory_daily group by IMPRESSIONS""",
    "coerce_double": _with(raw_geo_monthly=RAW["geo_monthly"]) + f"""
select AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE as raw_text, count(*) as n,
       {_float64('AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE')} as value
from raw_geo_monthly group by AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE""",
    "reconcile": _reconcile(),
    "reconcile_rows": _with(**_FR, **_REPLACED_DAY) + """
select s.*, cast(1 as bigint) as n_a, cast(0 as bigint) as n_b, 'only_a' as status from stored s
where s.date = date '2024-01-10' or (s.date = date '2024-01-15' and s.ad_unit_name not in (select ad_unit_name from batch))""",
    # Pages and CSV dumps carry the same rows as the extract: the oracle is
    # the report built straight from the extract.
    "flatten_pages": _with(**_FR) + FILL_RATE,
    "flatten_json_pages": _with(**_FR) + FILL_RATE,
    "csv_dump_mixed_headers": _with(**_INV) + "select * from inventory",
    "report_sorted": _with(**_FR) + FILL_RATE + "\norder by date nulls first, ad_unit_name nulls first",
    "top_duplicates": _with(**_GEO) + """
select report_date, country_code, count(*) as cnt from geo group by 1, 2 having count(*) > 1
order by cnt desc, report_date asc nulls first, country_code asc nulls first limit 5""",
    "local_yesterday": """
select cast((ts at time zone 'UTC') at time zone 'Europe/Paris' as date) - 1 as yesterday, count(*) as events from events group by 1""",
    "coerce_int_text": f"select raw_text, n, coalesce(try_cast(case when regexp_full_match(trim(raw_text), '[+-]?[0-9]+') then raw_text end as bigint), "
    f"try_cast(case when try_cast({_PLAIN} as double) = floor(try_cast({_PLAIN} as double)) then try_cast({_PLAIN} as double) end as bigint)) as value from ({NUMERIC_SQL.format(lineitem='lineitem')})",
    "coerce_double_text": f"select raw_text, n, {_float64(_PLAIN)} as value from ({NUMERIC_SQL.format(lineitem='lineitem')})",
    # Loads are read back from their tables; the oracle is what each must hold.
    "load_append": _with(**_FR) + FILL_RATE,
    "load_empty": _with(**_FR) + FILL_RATE,
    "load_overwrite": _with(**_KEPT_GEO) + f"select * from kept where {_MONTHS_REPLACED}",
    "load_replace_day": _with(**_FR, **_REPLACED_DAY) + """select * from stored where date is distinct from date '2024-01-15'
union all select * from batch""",
    "load_replace_month": _with(**_KEPT_GEO) + f"select {_geo_cols(f'case when {_MONTHS_REPLACED} then ad_server_clicks * 2 else ad_server_clicks end')} from kept",
    "load_replace_range": _with(**_FR, **_REPLACED_RANGE) + """select * from stored
where not coalesce(date between date '2024-01-10' and date '2024-01-20', false) union all select * from batch""",
    "load_dry_run": _dry_run(),
    "load_log": _with(**_FR, **_REPLACED_RANGE) + f"""
select 'INFO' as severity, 'fill_rate' as report_type, 'slice' as mode, cast(null as date) as slice_start, cast(null as date) as slice_end,
       (select count(*) from stored) as rows_written, {_nulls('stored')} as null_metric_values, 'SUCCESS' as status, cast(null as varchar) as message
union all
select 'INFO', 'fill_rate', 'range', date '2024-01-10', date '2024-01-20', (select count(*) from batch), {_nulls('batch')}, 'SUCCESS', null
union all
select 'INFO', 'fill_rate', 'slice', null, null, 0, 0, 'SUCCESS', 'No data available'""",
    "load_log_coerced": f"""
with t as (select raw_text, n, case when regexp_full_match(trim(raw_text), '[+-]?[0-9]+') and try_cast(raw_text as bigint) is not null then true
                  else coalesce(try_cast({_PLAIN} as double) = floor(try_cast({_PLAIN} as double))
                                and abs(try_cast({_PLAIN} as double)) < 9.2e18, false) end as is_int
          from ({NUMERIC_SQL.format(lineitem='lineitem')})),
c as (select cast(sum(n) filter (where raw_text is not null and not is_int) as bigint) as bad, cast(sum(n) as bigint) as total from t)
select 'inventory_daily' as report_type, total as rows_read, total as rows_written, bad + total as coerced_to_null, column_name, column_coerced
from c, lateral (select * from (values ('date', cast(0 as bigint)), ('ad_server_impressions', bad), ('ad_server_clicks', 0),
  ('active_view_measurable_impressions', total), ('active_view_viewable_impressions', 0)) v(column_name, column_coerced))""",
    "job_backfill": _BACKFILLED,
    "job_backfill_chunked": _BACKFILLED,
    "job_backfill_geo_csv": _with(**_KEPT_GEO) + "select * from kept",
    "job_backfill_legacy": _with(raw_geo_monthly=RAW["geo_monthly"]) + f"""
select {_int64('COUNTRY_CODE')} as country_id, COUNTRY_NAME as country_name, IMPRESSIONS as ad_server_impressions,
       CLICKS as ad_server_clicks, {_month_year('MONTH_YEAR')} as report_date
from raw_geo_monthly""",
    "job_audit": _with(**_KEPT_GEO) + _findings("geo_monthly", "kept", "report_date", "report_date, country_code", _GEO_TYPES),
    "job_audit_incremental": _with(**_KEPT_GEO, now=f"select * from kept where not coalesce({_MONTHS_REPLACED} and ad_server_clicks % 2 <> 0, false)")
    + _findings("geo_monthly", "now", "report_date", "report_date, country_code", _GEO_TYPES),
    "audit_profile_stored": _with(**_KEPT_GEO, **_FR, fill_rate=FILL_RATE) + "\nunion all\n".join(
        f"""select '{t}' as table_name, count(*) as total_rows,
       count(*) filter (where {d} is null) as null_dates, min({d}) as min_date, max({d}) as max_date,
       count(distinct {d}) as unique_dates from {c}""" for t, c, d in (("fill_rate", "fill_rate", "date"), ("geo_monthly", "kept", "report_date"))),
    "job_backfill_resumed": _with(**_KEPT_GEO, b="select date '1996-01-15' as s, date '1996-05-10' as e", c=_months("b"),
                                  l="select report_date, count(*) as n, sum(ad_server_clicks + case when report_date = date '1996-03-01' then 1 else 0 end) as clicks from kept group by 1")
    + """select month_label, case when m = date '1996-03-01' then 'SUCCESS' else 'SKIPPED' end as status,
       cast(coalesce(n, 0) as bigint) as rows, cast(case when m = date '1996-01-01' then (select clicks from l where report_date = m) else clicks end as bigint) as clicks
from c left join l on report_date = m""",
    "job_audit_all": _with(**_KEPT_GEO, **_FR, fill_rate=FILL_RATE)
    + "select 'no_such_table' as table_name, 'error' as \"check\", 'ERROR' as status, cast(null as bigint) as value, 'missing' as detail\nunion all\n"
    + "\nunion all\n".join(
        _findings(name, src, date, key, n) + f"\nunion all\nselect '{name}', 'summary', 'INFO', (select count(*) from {src}), null"
        for name, src, date, key, n in (("fill_rate_audited", "fill_rate", "date", "date, ad_unit_name", _FILL_TYPES),
                                        ("geo_audited", "kept", "report_date", "report_date, country_code", _GEO_TYPES))),
    "table_scan": _with(**_FR, fill_rate=FILL_RATE) + "select * from fill_rate where date between date '2024-01-10' and date '2024-01-20'",
    "ad_hoc_sql": _with(**_FR, fill_rate=FILL_RATE) + """
select ad_unit_name, cast(sum(ad_requests) as bigint) as ad_requests, count(distinct date) as days from fill_rate group by ad_unit_name""",
    "csv_dump": _with(**_INV) + "select * from inventory",
    "csv_dump_fill_rate": _with(**_FR) + FILL_RATE,
    "csv_dump_geo": _with(**_GEO) + "select * from geo where country_name is not null",
    "legacy_inventory_daily": _with(raw_inventory_daily=RAW["inventory_daily"]) + f"""
select {_date_int('DATE')} as date,
       {_int64("regexp_extract(AD_UNIT_NAME, '[0-9]+', 0)")} as ad_unit_id, AD_UNIT_NAME as ad_unit_name,
       {_int64("regexp_extract(ORDER_NAME, '[0-9]+', 0)")} as order_id, ORDER_NAME as order_name,
       DEVICE_CATEGORY_NAME as device_category, RENDERED_CREATIVE_SIZE as creative_size,
       {_int64('IMPRESSIONS')} as ad_server_impressions, {_int64('CLICKS')} as ad_server_clicks
from raw_inventory_daily""",
    "legacy_geo_monthly": _with(raw_geo_monthly=RAW["geo_monthly"]) + f"""
select {_int64('COUNTRY_CODE')} as country_id, COUNTRY_NAME as country_name,
       IMPRESSIONS as ad_server_impressions, CLICKS as ad_server_clicks,
       {_month_year('MONTH_YEAR')} as report_date
from raw_geo_monthly""",
    "run_report_last_month": """
select cast(l_shipdate as date) as date, l_returnflag as ad_unit_name,
       cast(sum(cast(l_quantity as bigint)) as bigint) as ad_server_impressions
from lineitem
where cast(l_shipdate as date) between
      (select cast(date_trunc('month', max(cast(l_shipdate as date)) + 1 - interval 1 month) as date) from lineitem)
  and (select last_day(cast(max(cast(l_shipdate as date)) + 1 - interval 1 month as date)) from lineitem)
group by 1, 2""",
    "run_report_yesterday": """
select cast(l_shipdate as date) as date, l_returnflag as ad_unit_name,
       cast(sum(cast(l_quantity as bigint)) as bigint) as ad_server_impressions
from lineitem
where cast(l_shipdate as date) = (select max(cast(l_shipdate as date)) + 1 - 1 from lineitem)
group by 1, 2""",
    "audit_duplicates_inventory_full_key": _with(**_INV) + """
select date, ad_unit_top_level, ad_unit_name, order_name, device_category, creative_size, count(*) as cnt
from inventory
group by date, ad_unit_top_level, ad_unit_name, order_name, device_category, creative_size
having count(*) > 1""",
}
