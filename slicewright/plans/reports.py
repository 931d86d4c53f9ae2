"""Per-report pipelines (J-7): raw extract → typed report rows.

Two raw forms exist: flattened paged results with API names (``report_*``)
and CSV dumps with ``Dimension.X``/``Column.X`` headers (``csv_*``, used by
the backfill), plus two legacy CSV reports that carry ids.  Every pipeline is
lazy; all but fill rate are a single narrow projection.  Fill rate adds one
grouped sum (partial + final aggregate, one exchange on its two keys).

``coerced`` is an ``Observation`` that takes, per typed column, the number of
values that were there and became NULL (see ``projection.apply_types``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import registry
from ..functions import dates
from ..operators.dedupe import dedupe_sum, ratio_of_sums
from ..operators.projection import (
    apply_types,
    drop_null_keys,
    keep_expected,
    rename_mapped,
    with_report_date,
)

R = registry.REPORTS


def transform(raw: DataFrame, spec: registry.ReportSpec, coerced: Observation | None = None) -> DataFrame:
    """J-1 + J-6: rename by the report's map, then type by its type map."""
    return apply_types(rename_mapped(raw, spec.column_map), spec.type_map, coerced)


def _fill_rate_from_typed(df: DataFrame) -> DataFrame:
    spec = R["fill_rate"]
    df = keep_expected(df, spec.expected)
    df = dedupe_sum(df, registry.FILL_RATE_DEDUPE_KEYS, registry.FILL_RATE_SUM_COLUMNS)
    num, den, out = registry.FILL_RATE_RATIO
    df = ratio_of_sums(df, num, den, out)
    present = set(df.columns)
    return df.select(*[c for c in spec.columns if c in present])


# -- flattened paged results ------------------------------------------------

def report_fill_rate(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    """Fill rate: rows of one (date, ad unit) from several hierarchy levels are
    summed and the rate is recomputed as impressions / requests."""
    return _fill_rate_from_typed(transform(raw, R["fill_rate"], coerced))


def report_inventory_daily(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    spec = R["inventory_daily"]
    return keep_expected(transform(raw, spec, coerced), spec.expected)


def report_geo_monthly(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    return transform(raw, R["geo_monthly"], coerced)


def report_audience_interest(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    return transform(raw, R["audience_interest"], coerced)


def report_audience_demographics(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    return transform(raw, R["audience_demographics"], coerced)


def present(df: DataFrame, keys) -> DataFrame:
    """L-2: rows ordered by their group keys, for display or export only
    (never before a write: a global sort is a range shuffle)."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys])


REPORT_PIPELINES = {
    "fill_rate": report_fill_rate,
    "inventory_daily": report_inventory_daily,
    "geo_monthly": report_geo_monthly,
    "audience_interest": report_audience_interest,
    "audience_demographics": report_audience_demographics,
}


# -- CSV dumps (backfill) ---------------------------------------------------

_LOGICAL = {"date": "date", "string": "string", "bigint": "int64", "double": "float64"}


def _logical_types(spec: registry.ReportSpec, *without: str) -> dict[str, str]:
    """The type of every table column, as a dump's text columns become it."""
    return {f.name: _LOGICAL[f.dataType.simpleString()] for f in spec.schema.fields if f.name not in without}


def csv_inventory_daily(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    spec = R["inventory_daily"]
    df = rename_mapped(raw, registry.CSV_HIERARCHY_COLUMNS, spec.csv_map)
    df = keep_expected(df, spec.expected)
    return apply_types(df, _logical_types(spec), coerced)


def csv_fill_rate(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    """Backfill fill rate, deduplicated exactly like the paged form."""
    spec = R["fill_rate"]
    df = rename_mapped(raw, {"Ad unit 2": "ad_unit_name"}, spec.csv_map)
    df = keep_expected(df, spec.expected)
    df = apply_types(df, _logical_types(spec), coerced)
    return _fill_rate_from_typed(df)


def csv_geo_monthly(raw: DataFrame, report_date=None, coerced: Observation | None = None) -> DataFrame:
    """Backfill geo: the month comes from the chunk being loaded.

    ``report_date`` is the chunk's first day (a date or a Column); when it is
    None the row's own month (``Dimension.MONTH_YEAR`` or ``MONTH_YEAR``) is
    used, so one job can load many months at once.  Subtotal rows with a NULL
    country name are dropped.
    """
    spec = R["geo_monthly"]
    if report_date is None:
        key = next((c for c in ("Dimension.MONTH_YEAR", "MONTH_YEAR") if c in raw.columns), None)
        if key is None:
            raise ValueError("geo dump without a month column: pass report_date (the chunk's first "
                             "day, e.g. from the landing folder)")
        report_date = dates.month_year_to_date(F.col(f"`{key}`"))
    df = with_report_date(raw, report_date, "__report_date")
    df = rename_mapped(df, spec.csv_map)
    df = keep_expected(df, [c for c in spec.columns if c != "report_date"] + ["__report_date"])
    df = df.withColumnRenamed("__report_date", "report_date")
    df = drop_null_keys(df, "country_name")
    return apply_types(df, _logical_types(spec, "report_date"), coerced)


def report_geo_backfill(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    """Backfill geo over API-named rows: report_date from each row's month."""
    spec = R["geo_monthly"]
    df = transform(raw, spec, coerced)
    df = drop_null_keys(df, "country_name")
    return df.select(*[c for c in spec.columns if c in set(df.columns)])


# -- legacy CSV reports (with ids, no Active View) --------------------------

def legacy_inventory_daily(raw: DataFrame, coerced: Observation | None = None) -> DataFrame:
    spec = registry.LEGACY_REPORTS["inventory_daily"]
    df = keep_expected(rename_mapped(raw, spec.csv_map), spec.expected)
    views = {c: "int64" for c in spec.expected if c not in spec.columns}  # Active View metrics, where a dump has them
    return apply_types(df, _logical_types(spec) | views, coerced)


def legacy_geo_monthly(raw: DataFrame, report_date=None, coerced: Observation | None = None) -> DataFrame:
    """Legacy geo: country ids; subtotal rows are kept; ``report_date`` is the
    chunk's first day (a date, or a Column such as the landing folder's), by
    default the first day of the previous month."""
    spec = registry.LEGACY_REPORTS["geo_monthly"]
    df = with_report_date(raw, report_date, "__report_date")
    df = keep_expected(rename_mapped(df, spec.csv_map), list(spec.expected) + ["__report_date"])
    df = df.withColumnRenamed("__report_date", "report_date")
    return apply_types(df, _logical_types(spec, "report_date"), coerced)


LEGACY_PIPELINES = {"legacy_inventory_daily": legacy_inventory_daily, "legacy_geo_monthly": legacy_geo_monthly}
