"""Report specifications.

A report is a raw extract (API column names) turned into a typed, partitioned
table.  Everything that must equal the source system's naming lives here as
plain constants; the operators elsewhere are generic and take a ``ReportSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Report names, table names, column maps, type maps, schemas,
# partition columns and duplicate keys of the five reports.  These must stay
# exactly as written for loaded tables to match the existing ones.
# ---------------------------------------------------------------------------

TIMEZONE = "Europe/Paris"

TABLES = {
    "audience_interest": "report_audience_interest",
    "inventory_daily": "inventory_daily",
    "audience_demographics": "report_audience_demographics",
    "fill_rate": "report_fill_rate",
    "geo_monthly": "geo_monthly",
}

COLUMN_MAPPINGS = {
    "audience_interest": {
        "MONTH_YEAR": "report_date",
        "INTEREST": "interest_category",
        "SESSIONS": "sessions",
        "GOOGLE_ANALYTICS_IMPRESSIONS": "ga_impressions",
        "BOUNCE_RATE": "bounce_rate",
        "ENGAGEMENT_RATE": "engagement_rate",
        "ACTIVE_USERS": "active_users",
        "GOOGLE_ANALYTICS_VIEWS": "ga_views",
        "GOOGLE_ANALYTICS_VIEWS_PER_USER": "ga_views_per_user",
        "AD_VIEWERS": "ad_viewers",
    },
    "inventory_daily": {
        "DATE": "date",
        "AD_UNIT_NAME_TOP_LEVEL": "ad_unit_top_level",
        "AD_UNIT_NAME": "ad_unit_name",
        "AD_UNIT_NAME_LEVEL_1": "ad_unit_level_1",
        "AD_UNIT_NAME_LEVEL_2": "ad_unit_level_2",
        "ORDER_NAME": "order_name",
        "DEVICE_CATEGORY_NAME": "device_category",
        "RENDERED_CREATIVE_SIZE": "creative_size",
        "IMPRESSIONS": "ad_server_impressions",
        "CLICKS": "ad_server_clicks",
        "AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS": "active_view_measurable_impressions",
        "ACTIVE_VIEW_VIEWABLE_IMPRESSIONS": "active_view_viewable_impressions",
    },
    "audience_demographics": {
        "MONTH_YEAR": "report_date",
        "GENDER_NAME": "gender",
        "AGE_BRACKET_NAME": "age_bracket",
        "SESSIONS": "sessions",
        "GOOGLE_ANALYTICS_IMPRESSIONS": "ga_impressions",
        "BOUNCE_RATE": "bounce_rate",
        "ACTIVE_USERS": "active_users",
        "GOOGLE_ANALYTICS_VIEWS": "ga_views",
        "GOOGLE_ANALYTICS_VIEWS_PER_USER": "ga_views_per_user",
        "AD_VIEWERS": "ad_viewers",
    },
    "fill_rate": {
        "DATE": "date",
        "AD_UNIT_NAME": "ad_unit_name",
        "UNFILLED_IMPRESSIONS": "unfilled_impressions",
        "CODE_SERVED_COUNT": "code_served_count",
        "RESPONSES_SERVED": "responses_served",
        "AD_SERVER_IMPRESSIONS": "ad_server_impressions",
        "FILL_RATE": "fill_rate",
        "AD_REQUESTS": "ad_requests",
    },
    "geo_monthly": {
        "COUNTRY_NAME": "country_name",
        "COUNTRY_CODE": "country_code",
        "MONTH_YEAR": "report_date",
        "IMPRESSIONS": "ad_server_impressions",
        "CLICKS": "ad_server_clicks",
        "AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE": "active_view_measurable_rate",
        "AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS": "active_view_viewable_impressions",
    },
}

# Logical type per target column, applied in this order.
TYPE_CONVERSIONS = {
    "audience_interest": {
        "report_date": "month_year",
        "interest_category": "string",
        "bounce_rate": "float64",
        "engagement_rate": "float64",
        "ga_views_per_user": "float64",
        "sessions": "int64",
        "ga_impressions": "int64",
        "active_users": "int64",
        "ga_views": "int64",
        "ad_viewers": "int64",
    },
    "inventory_daily": {
        "date": "date_int",
        "ad_server_impressions": "int64",
        "ad_server_clicks": "int64",
        "active_view_measurable_impressions": "int64",
        "active_view_viewable_impressions": "int64",
    },
    "audience_demographics": {
        "report_date": "month_year",
        "gender": "string",
        "age_bracket": "string",
        "bounce_rate": "float64",
        "ga_views_per_user": "float64",
        "sessions": "int64",
        "ga_impressions": "int64",
        "active_users": "int64",
        "ga_views": "int64",
        "ad_viewers": "int64",
    },
    "fill_rate": {
        "date": "date_int",
        "ad_unit_name": "string",
        "unfilled_impressions": "int64",
        "code_served_count": "int64",
        "responses_served": "int64",
        "ad_server_impressions": "int64",
        "fill_rate": "float64",
        "ad_requests": "int64",
    },
    "geo_monthly": {
        "report_date": "month_year",
        "country_name": "string",
        "country_code": "string",
        "ad_server_impressions": "int64",
        "ad_server_clicks": "int64",
        "active_view_measurable_rate": "float64",
        "active_view_viewable_impressions": "int64",
    },
}

# (name, type, required) in table order.
SCHEMAS = {
    "audience_interest": [
        ("report_date", "DATE", True),
        ("interest_category", "STRING", True),
        ("sessions", "INT64", False),
        ("ga_impressions", "INT64", False),
        ("bounce_rate", "FLOAT64", False),
        ("engagement_rate", "FLOAT64", False),
        ("active_users", "INT64", False),
        ("ga_views", "INT64", False),
        ("ga_views_per_user", "FLOAT64", False),
        ("ad_viewers", "INT64", False),
    ],
    "inventory_daily": [
        ("date", "DATE", True),
        ("ad_unit_top_level", "STRING", False),
        ("ad_unit_name", "STRING", False),
        ("order_name", "STRING", False),
        ("device_category", "STRING", False),
        ("creative_size", "STRING", False),
        ("ad_server_impressions", "INT64", False),
        ("ad_server_clicks", "INT64", False),
        ("active_view_measurable_impressions", "INT64", False),
        ("active_view_viewable_impressions", "INT64", False),
    ],
    "audience_demographics": [
        ("report_date", "DATE", True),
        ("gender", "STRING", False),
        ("age_bracket", "STRING", False),
        ("sessions", "INT64", False),
        ("ga_impressions", "INT64", False),
        ("bounce_rate", "FLOAT64", False),
        ("active_users", "INT64", False),
        ("ga_views", "INT64", False),
        ("ga_views_per_user", "FLOAT64", False),
        ("ad_viewers", "INT64", False),
    ],
    "fill_rate": [
        ("date", "DATE", True),
        ("ad_unit_name", "STRING", False),
        ("unfilled_impressions", "INT64", False),
        ("code_served_count", "INT64", False),
        ("responses_served", "INT64", False),
        ("ad_server_impressions", "INT64", False),
        ("fill_rate", "FLOAT64", False),
        ("ad_requests", "INT64", False),
    ],
    "geo_monthly": [
        ("report_date", "DATE", True),
        ("country_name", "STRING", True),
        ("country_code", "STRING", True),
        ("ad_server_impressions", "INT64", False),
        ("ad_server_clicks", "INT64", False),
        ("active_view_measurable_rate", "FLOAT64", False),
        ("active_view_viewable_impressions", "INT64", False),
    ],
}

PARTITIONS = {
    "audience_interest": ("report_date", "MONTH"),
    "inventory_daily": ("date", "DAY"),
    "audience_demographics": ("report_date", "MONTH"),
    "fill_rate": ("date", "DAY"),
    "geo_monthly": ("report_date", "MONTH"),
}

# Keys the audit groups by to find duplicates.
DUPLICATE_KEYS = {
    "inventory_daily": ("date", "ad_unit_name", "order_name", "device_category", "creative_size"),
    "geo_monthly": ("report_date", "country_code"),
    "audience_interest": ("report_date", "interest_category"),
    "audience_demographics": ("report_date", "gender", "age_bracket"),
    "fill_rate": ("date", "ad_unit_name"),
}

# The inventory audit key omits ad_unit_top_level; the full key is audited
# beside it so both counts are reported.
FULL_DUPLICATE_KEYS = {
    "inventory_daily": ("date", "ad_unit_top_level", "ad_unit_name", "order_name", "device_category",
                        "creative_size"),
}

# Reports whose columns are cut to their table's (in its order) after the rename.
KEEP_EXPECTED = ("inventory_daily", "fill_rate")

# Fill rate: hierarchy rows of one (date, ad unit) are summed, then the rate
# is recomputed as impressions / requests.
FILL_RATE_DEDUPE_KEYS = ("date", "ad_unit_name")
FILL_RATE_SUM_COLUMNS = (
    "unfilled_impressions", "code_served_count", "responses_served",
    "ad_server_impressions", "ad_requests",
)
FILL_RATE_RATIO = ("ad_server_impressions", "ad_requests", "fill_rate")

# CSV dump headers (report-job download) → table columns.
# "Ad unit 1" / "Ad unit 2" are the hierarchical ad-unit levels.
CSV_HIERARCHY_COLUMNS = {"Ad unit 1": "ad_unit_top_level", "Ad unit 2": "ad_unit_name"}

CSV_COLUMN_MAPPINGS = {
    "inventory_daily": {
        "Dimension.DATE": "date",
        "Dimension.ORDER_NAME": "order_name",
        "Dimension.DEVICE_CATEGORY_NAME": "device_category",
        "Dimension.CREATIVE_SIZE": "creative_size",
        "Column.AD_SERVER_IMPRESSIONS": "ad_server_impressions",
        "Column.AD_SERVER_CLICKS": "ad_server_clicks",
        "Column.AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS": "active_view_measurable_impressions",
        "Column.AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS": "active_view_viewable_impressions",
    },
    "fill_rate": {
        "Dimension.DATE": "date",
        "Dimension.AD_UNIT_NAME": "ad_unit_name",
        "Column.TOTAL_INVENTORY_LEVEL_UNFILLED_IMPRESSIONS": "unfilled_impressions",
        "Column.TOTAL_CODE_SERVED_COUNT": "code_served_count",
        "Column.TOTAL_RESPONSES_SERVED": "responses_served",
        "Column.AD_SERVER_IMPRESSIONS": "ad_server_impressions",
        "Column.TOTAL_FILL_RATE": "fill_rate",
        "Column.TOTAL_AD_REQUESTS": "ad_requests",
    },
    "geo_monthly": {
        "Dimension.COUNTRY_NAME": "country_name",
        "Dimension.COUNTRY_CRITERIA_ID": "country_code",
        "Column.AD_SERVER_IMPRESSIONS": "ad_server_impressions",
        "Column.AD_SERVER_CLICKS": "ad_server_clicks",
        "Column.AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS_RATE": "active_view_measurable_rate",
        "Column.AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS": "active_view_viewable_impressions",
    },
}

# Legacy generation (ids, no Active View), CSV names → columns.
LEGACY_COLUMN_MAPPINGS = {
    "inventory_daily": {
        "Dimension.DATE": "date",
        "Dimension.AD_UNIT_ID": "ad_unit_id",
        "Dimension.AD_UNIT_NAME": "ad_unit_name",
        "Dimension.ORDER_ID": "order_id",
        "Dimension.ORDER_NAME": "order_name",
        "Dimension.DEVICE_CATEGORY_NAME": "device_category",
        "Dimension.CREATIVE_SIZE": "creative_size",
        "Column.AD_SERVER_IMPRESSIONS": "ad_server_impressions",
        "Column.AD_SERVER_CLICKS": "ad_server_clicks",
        "Column.AD_SERVER_ACTIVE_VIEW_MEASURABLE_IMPRESSIONS": "active_view_measurable_impressions",
        "Column.AD_SERVER_ACTIVE_VIEW_VIEWABLE_IMPRESSIONS": "active_view_viewable_impressions",
    },
    "geo_monthly": {
        "Dimension.COUNTRY_CRITERIA_ID": "country_id",
        "Dimension.COUNTRY_NAME": "country_name",
        "Column.AD_SERVER_IMPRESSIONS": "ad_server_impressions",
        "Column.AD_SERVER_CLICKS": "ad_server_clicks",
    },
}

LEGACY_SCHEMAS = {
    "inventory_daily": [
        ("date", "DATE", True),
        ("ad_unit_id", "INT64", False),
        ("ad_unit_name", "STRING", False),
        ("order_id", "INT64", False),
        ("order_name", "STRING", False),
        ("device_category", "STRING", False),
        ("creative_size", "STRING", False),
        ("ad_server_impressions", "INT64", False),
        ("ad_server_clicks", "INT64", False),
    ],
    "geo_monthly": [
        ("report_date", "DATE", True),
        ("country_id", "INT64", False),
        ("country_name", "STRING", False),
        ("ad_server_impressions", "INT64", False),
        ("ad_server_clicks", "INT64", False),
    ],
}

LEGACY_TABLES = {"inventory_daily": "report_inventory_daily", "geo_monthly": "report_geo_monthly"}

# Normalised category domains for the demographics report.
GENDER_VALUES = {"Homme": "Male", "Femme": "Female", "Male": "Male", "Female": "Female"}
AGE_BRACKETS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
UNKNOWN = "Unknown"

# ---------------------------------------------------------------------------

_SPARK_TYPES = {
    "DATE": T.DateType(),
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
}


def struct_type(columns) -> T.StructType:
    """StructType from (name, type, required) triples."""
    return T.StructType([T.StructField(n, _SPARK_TYPES[t], not req) for n, t, req in columns])


@dataclass(frozen=True)
class ReportSpec:
    """Everything the generic operators need to know about one report."""

    name: str
    table: str
    column_map: dict
    type_map: dict
    schema: T.StructType
    required: tuple
    partition_col: str
    partition_grain: str
    duplicate_key: tuple
    expected: tuple | None = None
    csv_map: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _spec(name: str) -> ReportSpec:
    part_col, grain = PARTITIONS[name]
    return ReportSpec(
        name=name,
        table=TABLES[name],
        column_map=COLUMN_MAPPINGS[name],
        type_map=TYPE_CONVERSIONS[name],
        schema=struct_type(SCHEMAS[name]),
        required=tuple(n for n, _, req in SCHEMAS[name] if req),
        partition_col=part_col,
        partition_grain=grain,
        duplicate_key=DUPLICATE_KEYS[name],
        expected=tuple(n for n, _, _ in SCHEMAS[name]) if name in KEEP_EXPECTED else None,
        csv_map=CSV_COLUMN_MAPPINGS.get(name, {}),
    )


REPORTS: dict[str, ReportSpec] = {n: _spec(n) for n in TABLES}


def _legacy_spec(name: str) -> ReportSpec:
    key = "date" if name == "inventory_daily" else "report_date"
    dup = ("date", "ad_unit_id", "order_id", "device_category", "creative_size") \
        if name == "inventory_daily" else ("report_date", "country_id")
    return ReportSpec(
        name=f"legacy_{name}",
        table=LEGACY_TABLES[name],
        column_map=LEGACY_COLUMN_MAPPINGS[name],
        type_map={},
        schema=struct_type(LEGACY_SCHEMAS[name]),
        required=(key,),
        partition_col=key,
        partition_grain="DAY",
        duplicate_key=dup,
        expected=tuple(LEGACY_COLUMN_MAPPINGS[name].values()),
        csv_map=LEGACY_COLUMN_MAPPINGS[name],
    )


LEGACY_REPORTS: dict[str, ReportSpec] = {n: _legacy_spec(n) for n in LEGACY_TABLES}


def report(name: str) -> ReportSpec:
    """Look up a report by its short name (``fill_rate``) or table name."""
    if name in REPORTS:
        return REPORTS[name]
    for spec in REPORTS.values():
        if spec.table == name:
            return spec
    for key, spec in LEGACY_REPORTS.items():
        if name in (spec.name, spec.table):
            return spec
    raise KeyError(f"unknown report {name!r}")
