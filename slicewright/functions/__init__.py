"""Scalar functions: native Column expressions, no Python UDFs."""

from .coerce import decode_dimension, decode_metric, to_float64, to_int64, to_text
from .dates import (
    date_int_to_date,
    date_to_int,
    date_to_month_year,
    first_of_month,
    first_of_previous_month,
    iso_to_date,
    last_of_month,
    local_date,
    month_label,
    month_year_to_date,
    yesterday,
)
from .demographics import normalise_age, normalise_gender, split_group_age, split_group_gender
from .kpi import fill_rate_percent, percent, ratio, serve_rate_percent

__all__ = [
    "date_int_to_date", "date_to_int", "date_to_month_year", "decode_dimension", "decode_metric",
    "fill_rate_percent", "first_of_month", "first_of_previous_month", "iso_to_date",
    "last_of_month", "local_date", "month_label", "month_year_to_date", "normalise_age",
    "normalise_gender", "percent", "ratio", "serve_rate_percent", "split_group_age",
    "split_group_gender", "to_float64", "to_int64", "to_text", "yesterday",
]
