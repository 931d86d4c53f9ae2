"""The report query (Q-1 … Q-6): dimensions × metrics over a date range.

``run_report`` is what the ad server computes for an extract, expressed over
one's own delivery facts: filter the date range, group by the dimensions, sum
the metrics.  Catalyst plans it as scan (with the range pushed into the
Parquet reader) → partial aggregate → exchange on the dimensions → final
aggregate.  Partial aggregation makes a hot dimension value cheap: each map
task ships one partial row per group.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Mapping, Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import registry
from ..functions import dates
from ..functions._util import column

# -- Q-2: relative date ranges (driver side, parameters only) -----------------


def resolve_range(kind: str, today: _dt.date | None = None, start=None, end=None):
    """Q-2: ``(start, end)`` inclusive for YESTERDAY, LAST_MONTH or CUSTOM_DATE.

    ``today`` is by default the calendar day in the report's time zone,
    whatever the host's clock is set to (``functions.dates.yesterday`` is the
    Column form).  CUSTOM_DATE with a
    missing bound is unbounded: ``(None, None)``.
    """
    kind = kind.upper()
    today = today or local_today()
    if kind == "YESTERDAY":
        d = today - _dt.timedelta(days=1)
        return d, d
    if kind == "LAST_MONTH":
        last = today.replace(day=1) - _dt.timedelta(days=1)
        return last.replace(day=1), last
    if kind == "CUSTOM_DATE":
        if start is None or end is None:
            return None, None
        return _as_date(start), _as_date(end)
    raise ValueError(f"unknown date range type {kind!r}")


def local_today(now: _dt.datetime | None = None) -> _dt.date:
    """The calendar day of ``now`` (aware; the present instant by default) in the report's time zone."""
    return (now or _dt.datetime.now(_dt.timezone.utc)).astimezone(ZoneInfo(registry.TIMEZONE)).date()


def _as_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v))


def range_predicate(df: DataFrame, col: str, start=None, end=None, encoding: str | None = None):
    """Inclusive ``[start, end]`` on a raw column, written so it is pushed down.

    ``encoding`` says how the column holds a date: ``date``, ``timestamp``
    (any time of the end day counts), ``date_int`` (YYYYMMDD, a number or
    text), ``iso`` (text YYYY-MM-DD) or ``month_year``.  Bounds are turned into raw keys, so the predicate is a
    plain comparison on the stored column (a ``PushedFilter`` and, on a
    partition column, a ``PartitionFilter``), never a function of it.
    """
    if start is None and end is None:
        return None
    c = column(col)
    dtype = df.schema[col].dataType
    if encoding is None:
        encoding = ("timestamp" if isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
                    else "date")
    lo = _as_date(start) if start is not None else None
    hi = _as_date(end) if end is not None else None
    preds = []
    if encoding == "date":
        if lo:
            preds.append(c >= F.lit(lo))
        if hi:
            preds.append(c <= F.lit(hi))
    elif encoding == "timestamp":
        tname = dtype.simpleString()
        if lo:
            preds.append(c >= F.lit(lo.isoformat()).cast(tname))
        if hi:
            preds.append(c < F.lit((hi + _dt.timedelta(days=1)).isoformat()).cast(tname))
    elif encoding in ("date_int", "iso"):
        form = "%Y-%m-%d" if encoding == "iso" else "%Y%m%d"
        key = str if encoding == "iso" or isinstance(dtype, T.StringType) else int
        if lo:
            preds.append(c >= F.lit(key(lo.strftime(form))))
        if hi:
            preds.append(c <= F.lit(key(hi.strftime(form))))
    elif encoding == "month_year":
        # Keys are not monotone across the overflow form (month part 12..99
        # rolls up to 8 years ahead), so the exact test is on the decoded
        # first-of-month date.  A raw-key superset of it is added so the scan
        # can still skip row groups: a key's year part is at most the
        # decoded year and at least the decoded year minus 8.
        if isinstance(dtype, T.StringType):
            c = c.try_cast("bigint")
        d = dates.month_year_to_date(c)
        base = dates.MONTH_YEAR_BASE_YEAR
        if lo:
            preds.append(c >= F.lit((lo.year - base - 8) * 100))
            preds.append(d >= F.lit(lo.replace(day=1)))
        if hi:
            preds.append(c <= F.lit((hi.year - base) * 100 + 99))
            preds.append(d <= F.lit(hi))
    else:
        raise ValueError(f"unknown date encoding {encoding!r}")
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


# -- Q-1 / Q-4 / Q-6 ------------------------------------------------------------

def _named(items) -> list[Column]:
    if isinstance(items, Mapping):
        return [(column(v) if isinstance(v, str) else v).alias(k) for k, v in items.items()]
    return [column(v) if isinstance(v, str) else v for v in items]


def run_report(
    df: DataFrame,
    dimensions: Sequence | Mapping,
    metrics: Sequence | Mapping,
    start=None,
    end=None,
    date_col: str | None = None,
    date_encoding: str | None = None,
    totals: bool = False,
    reach: str | Column | None = None,
    reach_name: str = "unique_reach",
    approx_reach: bool = False,
    level_name: str = "grouping_level",
    reach_rsd: float = 0.05,
) -> DataFrame:
    """Q-1: one row per dimension tuple with summed metrics over a date range.

    ``dimensions`` and ``metrics`` are names or ``{output: column}`` maps; the
    range ``[start, end]`` applies to ``date_col`` (see ``range_predicate``).
    ``totals=True`` (Q-4) adds subtotal and grand-total rows with
    ``grouping_level`` = ``grouping_id()`` (0 = detail row): the rows are
    aggregated to the detail grain first and its few groups are rolled up, so
    no input row is multiplied.  ``reach`` (Q-6)
    adds the number of distinct values of that column per group: exact
    ``count(distinct)`` by default (Spark de-duplicates on (group, value)
    first, so a hot group is spread over the value's hash), or a HyperLogLog
    estimate with ``approx_reach`` (relative error ``reach_rsd``).  With
    totals, the detail grain holds the distinct values, or a sketch of them,
    that the subtotals merge.
    """
    if date_col is not None:
        pred = range_predicate(df, date_col, start, end, date_encoding)
        if pred is not None:
            df = df.where(pred)
    dims = _named(dimensions)
    aggs = [F.sum(m).alias(n) for m, n in zip(_named(metrics), _metric_names(metrics))]
    if reach is not None:
        r = column(reach) if isinstance(reach, str) else reach
        aggs.append((F.approx_count_distinct(r, reach_rsd) if approx_reach else F.countDistinct(r))
                    .alias(reach_name))
    if totals:
        return _totals(df, dims, _named(metrics), _metric_names(metrics), reach, reach_name, approx_reach, level_name, reach_rsd)
    return df.groupBy(*dims).agg(*aggs)


def _totals(df: DataFrame, dims: list[Column], metrics: list[Column], names: list[str], reach, reach_name: str,
            approx_reach: bool, level_name: str, reach_rsd: float) -> DataFrame:
    """Q-4: sums at the detail grain, then rolled up."""
    keys = [f"__dim_{k}" for k in range(len(dims))]
    r = column(reach) if isinstance(reach, str) else reach
    # both levels of sums have the type of one
    single = df.select(*dims).columns, dict(df.agg(*[F.sum(m).alias(n) for m, n in zip(metrics, names)]).dtypes)
    keyed = df.select(*[d.alias(k) for d, k in zip(dims, keys)], *[m.alias(f"__m_{k}") for k, m in enumerate(metrics)],
                      *([] if r is None else [r.alias("__reach")]))
    grain, parts = list(keys), [F.sum(f"__m_{k}").alias(f"__m_{k}") for k in range(len(names))]
    out = [F.sum(f"__m_{k}").cast(single[1][n]).alias(n) for k, n in enumerate(names)]
    if r is not None and approx_reach:
        parts.append(F.hll_sketch_agg("__reach", sketch_bits(reach_rsd)).alias("__reach"))
        out.append(F.hll_sketch_estimate(F.hll_union_agg("__reach")).alias(reach_name))
    elif r is not None:
        grain.append("__reach")
        out.append(F.countDistinct("__reach").alias(reach_name))
    fine = keyed.groupBy(*grain).agg(*parts) if parts else keyed.select(*grain).distinct()
    rolled = fine.rollup(*keys).agg(*out, F.grouping_id().alias(level_name))
    return rolled.select(*[F.col(k).alias(n) for k, n in zip(keys, single[0])], *names, *([] if r is None else [reach_name]), level_name)


def sketch_bits(rsd: float) -> int:
    """log2 of the registers of a sketch whose relative standard error is at most ``rsd``."""
    return min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))


def _metric_names(metrics) -> list[str]:
    if isinstance(metrics, Mapping):
        return list(metrics.keys())
    if not all(isinstance(m, str) for m in metrics):
        raise TypeError("metrics: give column names, or a {name: Column} map")
    return list(metrics)


def drop_subtotals(df: DataFrame, level_name: str = "grouping_level", keys=()) -> DataFrame:
    """Q-4: keep detail rows only.  With a rollup we made, ``grouping_level =
    0``; for an extract that came with subtotal rows, rows whose keys are
    NULL."""
    if level_name in df.columns:
        return df.where(F.col(level_name) == 0).drop(level_name)
    cond = None
    for k in keys:
        p = column(k).isNotNull()
        cond = p if cond is None else cond & p
    return df if cond is None else df.where(cond)


# -- Q-3 --------------------------------------------------------------------------

def hierarchy_levels(df: DataFrame, col, levels: int, sep: str = "/", prefix: str = "level_") -> DataFrame:
    """Q-3: one column per hierarchy level of a path (``a/b/c``).

    Level i is the i-th part (NULL past the end).  ``F.get`` is used instead
    of ``[]`` because under ANSI mode ``[]`` raises on a short path.
    """
    c = column(col) if isinstance(col, str) else col
    parts = F.split(c, "\\Q" + sep + "\\E")
    return df.withColumns({f"{prefix}{i + 1}": F.get(parts, i) for i in range(levels)})


# -- A-1 over Q-3 -------------------------------------------------------------

def hierarchy_rollup(df: DataFrame, path: str, metrics: Sequence[str], keys: Sequence[str] = (), sep: str = "/") -> DataFrame:
    """A-1 over a hierarchy: the sums of every path prefix, from rows that may stand at several levels.

    An extract of a hierarchy repeats what a unit delivered in the rows of the
    units above it.  Rows whose path is a proper prefix of another row's path
    (of the same ``keys``) are such repetitions and are left out; the other
    rows are summed into each prefix of their path.  Output: the keys, the
    path, its ``level`` (1 = top), the metrics, and ``units``, the number of
    different lowest paths below (or at) it.  Rows without a path are summed
    as level 0.  The rows are aggregated to one per path before any prefix is
    made, so a hot path costs one row per task and a path costs its depth.
    """
    p = column(path).alias("__path")
    fine = df.select(*[column(k) for k in keys], p, *[column(m) for m in metrics]).groupBy(*[column(k) for k in keys], "__path").agg(
        *[F.sum(column(m)).alias(m) for m in metrics])
    types = dict(fine.dtypes)
    parts = F.split(F.col("__path"), "\\Q" + sep + "\\E")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), sep))
    # each path and its prefixes meet by name: a path that is another one's prefix is an ancestor
    ups = fine.select(*[column(k).alias(f"__k{n}") for n, k in enumerate(keys)], "__path", F.explode(prefixes).alias("__above"))
    above = ups.where(F.col("__path") != F.col("__above")).drop("__path").distinct()
    same = F.col("__path") == F.col("__above")
    for n, k in enumerate(keys):
        same = same & column(k).eqNullSafe(F.col(f"__k{n}"))
    no_path = F.array(F.lit(None).cast("string"))
    lowest = fine.join(above, same, "left_anti").withColumn("__prefix", F.explode(F.when(F.col("__path").isNull(), no_path).otherwise(prefixes)))
    level = F.when(F.col("__prefix").isNull(), 0).otherwise(F.size(F.split(F.col("__prefix"), "\\Q" + sep + "\\E")))
    out = lowest.groupBy(*[column(k) for k in keys], "__prefix").agg(*[F.sum(column(m)).cast(types[m]).alias(m) for m in metrics], F.count(F.lit(1)).alias("units"))
    return out.select(*[column(k) for k in keys], F.col("__prefix").alias(path), level.cast("int").alias("level"), *[column(m) for m in metrics], "units")
