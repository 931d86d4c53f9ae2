"""Projections (J-1, J-3, J-4, J-5, J-6) and the NULL-key filter (P-1).

Each function is one ``select``/``where`` over the input, so a whole report
pipeline collapses into a single narrow stage: no shuffle, one codegen span.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import coerce, dates
from ..functions._util import column
from .report_query import resolve_range


def rename_mapped(df: DataFrame, *mappings: Mapping[str, str]) -> DataFrame:
    """J-1 / J-3: rename by ``source → target`` maps.

    Source names that are absent are ignored and unmapped columns are kept.
    When several present sources land on one target (a hierarchical ad-unit
    level and the flat ad-unit name), they become one column: the first
    non-NULL value, in map order.
    """
    pairs: list[tuple[str, str]] = []
    for m in mappings:
        pairs.extend(m.items())
    present = {c for c in df.columns}
    sources_of: dict[str, list[str]] = {}
    for src, dst in pairs:
        if src in present and src not in sources_of.get(dst, []):
            sources_of.setdefault(dst, []).append(src)
    target_of = {src: dst for dst, srcs in sources_of.items() for src in srcs}

    out: list[Column] = []
    emitted: set[str] = set()
    for c in df.columns:
        dst = target_of.get(c)
        if dst is None:
            if c in sources_of or c in emitted:
                continue  # an unmapped column shadowed by a rename target
            out.append(column(c))
            emitted.add(c)
            continue
        if dst in emitted:
            continue
        srcs = sources_of[dst]
        if dst in present and dst not in target_of:
            srcs = srcs + [dst]
        expr = column(srcs[0]) if len(srcs) == 1 else F.coalesce(*[column(s) for s in srcs])
        out.append(expr.alias(dst))
        emitted.add(dst)
    return df.select(*out)


_CONVERTERS = {
    "date": lambda c, t: dates.iso_to_date(c),
    "date_int": lambda c, t: dates.date_int_to_date(c),
    "month_year": lambda c, t: dates.month_year_to_date(c),
    "int64": coerce.to_int64,
    "float64": coerce.to_float64,
    "string": coerce.to_text,
}


def convert(c, logical_type: str, dtype=None) -> Column:
    """Typed conversion of one column by logical type name."""
    try:
        fn = _CONVERTERS[logical_type]
    except KeyError:
        raise ValueError(f"unknown logical type {logical_type!r}") from None
    return fn(column(c) if isinstance(c, str) else c, dtype)


def apply_types(df: DataFrame, type_map: Mapping[str, str], coerced: Observation | None = None) -> DataFrame:
    """J-6: convert columns by a ``column → logical type`` map in one select.

    Columns absent from the frame are skipped; other columns pass through.
    With ``coerced`` (K-13, X20), the rows that go by are counted per converted
    column where the raw value is there and the typed one is NULL, in the same
    pass that converts them.  (Spark counts the rows of tasks that are run
    again after a lost executor again.)
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = [
        convert(c, type_map[c], types[c]).alias(c) if c in type_map else column(c)
        for c in df.columns
    ]
    typed = [c for c in df.columns if c in type_map and type_map[c] != "string"]
    if coerced is None or not typed:
        return df.select(*out)
    both = df.select(*out, *[column(c).isNotNull().alias(f"__given_{k}") for k, c in enumerate(typed)])
    counts = [F.count_if(F.col(f"__given_{k}") & column(c).isNull()).alias(c) for k, c in enumerate(typed)]
    return both.observe(coerced, *counts).select(*[column(c) for c in df.columns])


def keep_expected(df: DataFrame, expected) -> DataFrame:
    """J-4: keep the expected columns that are present, in expected order."""
    present = set(df.columns)
    return df.select(*[column(c) for c in expected if c in present])


def with_report_date(df: DataFrame, value=None, name: str = "report_date") -> DataFrame:
    """J-5: attach a report date: a constant date, a Column per row, or by
    default the first day of the month before today (in the report's time zone)."""
    if value is None:
        value = resolve_range("LAST_MONTH")[0]
    if isinstance(value, (_dt.date, str)):
        value = F.lit(value).cast("date") if isinstance(value, str) else F.lit(value)
    return df.withColumn(name, value)


def drop_null_keys(df: DataFrame, *cols: str) -> DataFrame:
    """P-1: drop rows whose key is NULL (subtotal rows of a report)."""
    cond = None
    for c in cols:
        p = column(c).isNotNull()
        cond = p if cond is None else cond & p
    return df if cond is None else df.where(cond)
