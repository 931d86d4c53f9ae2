"""Value coercion (F-4, F-5, F-6) and the paged-result value decode (S-2, F-8).

Raw report columns arrive as text (CSV dumps, decoded pages) or as numbers.
Each coercion takes the input's Spark type so it can pick the cheapest exact
expression; with no type given the input is treated as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col_of

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


# A decimal number in plain or exponent notation, or a named special value.
# Spark's text cast also takes Java literals (``5d``, ``0x1p3``): those are no numbers here.
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"


def _text_to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def _whole_double_to_bigint(d: Column) -> Column:
    # A whole, finite double that fits a bigint; anything else is NULL.
    # (2**63 is the first that does not; the cast alone would clamp it.)
    return F.when(~F.isnan(d) & (d >= F.lit(-(2.0**63))) & (d < F.lit(2.0**63)) & (d == F.floor(d)), d.try_cast("bigint"))


def to_int64(c, dtype: T.DataType | None = None) -> Column:
    """F-4: nullable integer; unparsable or fractional input → NULL.

    Text is tried as an integer first (exact beyond 2**53) and then as a
    number in any notation (``1e3`` → 1000, `` 4 `` → 4).
    """
    c = col_of(c)
    if isinstance(dtype, _INTEGRAL):
        return c.cast("bigint")
    if isinstance(dtype, T.BooleanType):
        return c.cast("bigint")
    if isinstance(dtype, _FRACTIONAL):
        return _whole_double_to_bigint(c.cast("double"))
    text = c.cast("string") if dtype is not None and not isinstance(dtype, T.StringType) else c
    return F.coalesce(F.when(text.rlike(_INTEGER), text.try_cast("bigint")), _whole_double_to_bigint(_text_to_double(text)))


def to_float64(c, dtype: T.DataType | None = None) -> Column:
    """F-5: nullable double; unparsable input and NaN → NULL."""
    c = col_of(c)
    if isinstance(dtype, _INTEGRAL + _FRACTIONAL + (T.BooleanType,)):
        d = c.cast("double")
    else:
        d = _text_to_double(c if dtype is None or isinstance(dtype, T.StringType) else c.cast("string"))
    return F.when(~F.isnan(d), d)


def to_text(c, dtype: T.DataType | None = None) -> Column:
    """F-6: text; NULL stays NULL (never the word ``None``)."""
    return col_of(c).cast("string")


def decode_dimension(cell: Column) -> Column:
    """S-2 / F-8: a dimension cell is its text if non-empty, else its integer.

    A missing cell (short row) stays NULL; a present cell whose scalars are
    unset decodes to ``"0"`` (the source's "unknown").
    """
    text = F.nullif(cell.getField("string_value"), F.lit(""))
    num = F.coalesce(cell.getField("int_value"), F.lit(0).cast("bigint")).cast("string")
    return F.when(cell.isNotNull(), F.coalesce(text, num))


def decode_metric(cell: Column) -> Column:
    """S-2 / F-8: a metric cell is its double if non-zero, else its integer.

    Returned as text so integers keep every digit; F-4/F-5 type it afterwards.
    """
    dbl = F.coalesce(cell.getField("double_value"), F.lit(0.0))
    num = F.coalesce(cell.getField("int_value"), F.lit(0).cast("bigint"))
    return F.when(
        cell.isNotNull(),
        F.when(dbl != F.lit(0.0), dbl.cast("string")).otherwise(num.cast("string")),
    )
