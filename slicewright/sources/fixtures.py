"""Raw report extracts derived from the shared test tables.

The test tables (TPC-H-like ``lineitem``/``orders`` and the ``events``
stream) stand in for the ad server's delivery facts.  Each text below maps
one of them to a raw report extract with the API column names of
``registry.COLUMN_MAPPINGS``.  The texts are dialect-neutral: the same SQL
builds the raw rows in Spark (``spark.sql`` with DataFrame arguments) and in
DuckDB (the correctness oracle), so both sides start from identical input.

The derivation is a narrow projection of one table: it scales with the table
and adds no shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

RAW_SQL = {
    "inventory_daily": """
select cast(year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate) as bigint) as DATE,
       l_returnflag as AD_UNIT_NAME_TOP_LEVEL,
       concat('unit_', cast(l_suppkey % 20 as string)) as AD_UNIT_NAME,
       'level_1' as AD_UNIT_NAME_LEVEL_1,
       'level_2' as AD_UNIT_NAME_LEVEL_2,
       concat('order_', cast(l_orderkey % 100 as string)) as ORDER_NAME,
       l_linestatus as DEVICE_CATEGORY_NAME,
       cast(l_linenumber as string) as RENDERED_CREATIVE_SIZE,
       case when l_partkey % 50 = 0 then '-' else cast(cast(l_quantity as bigint) as string) end as IMPRESSIONS,
       cast(l_partkey % 5 as string) as CLICKS,
       cast(cast(l_quantity as bigint) as string) as AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS,
       cast(l_suppkey % 7 as string) as ACTIVE_VIEW_VIEWABLE_IMPRESSIONS
from {lineitem}
""",
    "fill_rate": """
select cast(year(ts)*10000 + month(ts)*100 + day(ts) as bigint) as DATE,
       event_type as AD_UNIT_NAME,
       case when event_type = 'signup' then null else user_id % 3 end as UNFILLED_IMPRESSIONS,
       cast(9 as bigint) as CODE_SERVED_COUNT,
       cast(8 as bigint) as RESPONSES_SERVED,
       event_id % 10 as AD_SERVER_IMPRESSIONS,
       cast(0.5 as double) as FILL_RATE,
       cast(case when event_type = 'error' then 0 else 10 end as bigint) as AD_REQUESTS
from {events}
""",
    "geo_monthly": """
select case when o_custkey % 25 = 0 then null
            else concat('Country_', cast(o_custkey % 25 as string)) end as COUNTRY_NAME,
       cast(o_custkey % 25 as string) as COUNTRY_CODE,
       cast((year(o_orderdate) - 2010)*100 + month(o_orderdate) - 1 as bigint) as MONTH_YEAR,
       o_orderkey % 1000 as IMPRESSIONS,
       o_orderkey % 7 as CLICKS,
       case when o_custkey % 10 = 0 then '-' else cast(o_custkey % 100 as string) end
         as AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE,
       o_orderkey % 500 as AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS
from {orders}
""",
    "audience_interest": """
select cast((year(ts) - 2010)*100 + month(ts) - 1 as bigint) as MONTH_YEAR,
       concat(event_type, '_', cast(user_id as string)) as INTEREST,
       event_id % 50 as SESSIONS,
       event_id % 60 as GOOGLE_ANALYTICS_IMPRESSIONS,
       value as BOUNCE_RATE,
       value as ENGAGEMENT_RATE,
       event_id % 40 as ACTIVE_USERS,
       event_id % 90 as GOOGLE_ANALYTICS_VIEWS,
       value as GOOGLE_ANALYTICS_VIEWS_PER_USER,
       event_id % 30 as AD_VIEWERS
from {events}
""",
    "audience_demographics": """
select cast((year(ts) - 2010)*100 + month(ts) - 1 as bigint) as MONTH_YEAR,
       case user_id % 3 when 0 then 'MALE_18_24' when 1 then 'FEMALE_25_34' else 'FEMALE_65_PLUS' end
         as GRP_DEMOGRAPHICS,
       case user_id % 3 when 0 then 'Homme' when 1 then 'Femme' else '0' end as GENDER_NAME,
       case user_id % 4 when 0 then '18-24' when 1 then '25-34' when 2 then '65+' else '0' end as AGE_BRACKET_NAME,
       event_id % 50 as SESSIONS,
       event_id % 60 as GOOGLE_ANALYTICS_IMPRESSIONS,
       value as BOUNCE_RATE,
       event_id % 40 as ACTIVE_USERS,
       event_id % 90 as GOOGLE_ANALYTICS_VIEWS,
       value as GOOGLE_ANALYTICS_VIEWS_PER_USER,
       event_id % 30 as AD_VIEWERS
from {events}
""",
}

_SOURCE_TABLE = {
    "inventory_daily": "lineitem",
    "fill_rate": "events",
    "geo_monthly": "orders",
    "audience_interest": "events",
    "audience_demographics": "events",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared test tables, read lazily (pruned and pushed down)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_report(spark: SparkSession, sf_dir: str, report: str) -> DataFrame:
    """Raw extract of ``report`` (API column names) derived from the tables."""
    src = _SOURCE_TABLE[report]
    return spark.sql(RAW_SQL[report], **{src: table(spark, sf_dir, src)})


# Texts that are or look like numbers, by a row's key, and how often each occurs.
NUMERIC_TEXTS = (
    "5", "-7", "+8", "007", " 4 ", "1e3", "1.5e1", "2.0", "1.25", ".5", "5.", "-", "", "abc", "N/A", "1,000", "1 2", "5d", "7f", "0x1p3", "0x10",
    "9007199254740993", "9223372036854775807", "9223372036854775808", "1e400", "nan", "NaN", "--5", "1e", "e5",
)
NUMERIC_SQL = (
    "select raw_text, count(*) as n from (select case l_partkey % "
    + str(len(NUMERIC_TEXTS) + 1)
    + " " + " ".join(f"when {k} then '{t}'" for k, t in enumerate(NUMERIC_TEXTS))
    + " end as raw_text from {lineitem}) t group by raw_text"
)


def numeric_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw_text, n): the texts above, NULL among them, derived from ``lineitem``."""
    return spark.sql(NUMERIC_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def raw_sql(report: str) -> str:
    """The same derivation for an engine with the tables registered by name."""
    src = _SOURCE_TABLE[report]
    return RAW_SQL[report].format(**{src: src})
