"""Relational operators over report DataFrames (all lazy, all native Spark)."""

from .audit import (
    audit_duplicates,
    audit_profile,
    audit_profiles,
    audit_summary,
    sample_rows,
    sample_values,
    top_duplicates,
)
from .calendar import explode_month_ranges, month_chunks, month_ranges
from .dedupe import dedupe_sum, ratio_of_sums
from .projection import apply_types, convert, drop_null_keys, keep_expected, rename_mapped, with_report_date
from .report_query import drop_subtotals, hierarchy_levels, range_predicate, resolve_range, run_report
from .setops import append_union, not_in_slice, replace_range, replace_slice

__all__ = [
    "append_union", "apply_types", "audit_duplicates", "audit_profile", "audit_profiles", "audit_summary",
    "convert", "dedupe_sum", "drop_null_keys", "drop_subtotals", "explode_month_ranges", "hierarchy_levels",
    "keep_expected", "month_chunks", "month_ranges", "not_in_slice", "range_predicate", "ratio_of_sums",
    "rename_mapped", "replace_range", "replace_slice", "resolve_range", "run_report",
    "sample_rows", "sample_values", "top_duplicates", "with_report_date",
]
