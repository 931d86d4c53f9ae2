"""Month chunks of a date range (G-1) with their labels (F-9, F-12).

The range is expanded with ``sequence`` + ``explode``: a generator bounded by
the number of months between the bounds, computed where the bounds are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions._util import col_of


def month_chunks(start, end) -> Column:
    """Array of ``struct(month_start, month_end)`` covering ``[start, end]``;
    the first and last chunk are clipped to the bounds; NULL (no rows once
    exploded) when start is after end."""
    s, e = F.to_date(col_of(start)), F.to_date(col_of(end))
    # start after end: no chunk (``sequence`` would raise on reversed bounds)
    months = F.when(s <= e, F.sequence(F.trunc(s, "MM"), e, F.expr("interval 1 month")))
    return F.transform(
        months,
        lambda m: F.struct(
            F.greatest(m, s).alias("month_start"),
            F.least(F.last_day(m), e).alias("month_end"),
        ),
    )


def explode_month_ranges(df: DataFrame, start: str, end: str, keep=()) -> DataFrame:
    """G-1 per row: one output row per month chunk of ``[start, end]``."""
    out = df.select(
        *[col_of(k) for k in keep],
        F.posexplode(month_chunks(start, end)).alias("chunk", "r"),
    )
    return out.select(
        *keep,
        (F.col("chunk") + 1).alias("chunk"),
        F.col("r.month_start").alias("month_start"),
        F.col("r.month_end").alias("month_end"),
        dates.month_label("r.month_start").alias("month_label"),
    )


def month_ranges(spark: SparkSession, start, end) -> DataFrame:
    """G-1: month chunks of one ``[start, end]`` range (dates or ISO text)."""
    df = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("start"), F.lit(str(end)).cast("date").alias("end"))
    return explode_month_ranges(df, "start", "end")
