"""Hierarchy dedupe (A-1) and ratio of sums (A-2).

``groupBy().agg(sum)`` is planned as partial aggregate → exchange on the keys
→ final aggregate, so a hot key (one ad unit holding a third of the rows)
ships one partial row per map task, not its raw rows: no salting is needed
for algebraic sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kpi
from ..functions._util import column


def dedupe_sum(df: DataFrame, keys, metrics) -> DataFrame:
    """A-1: one row per key tuple, the present metrics summed.

    A group whose metric is NULL on every row sums to 0, not NULL.  NULL keys
    form their own group.  Output: keys, then the summed metrics in order.
    """
    present = set(df.columns)
    aggs = [
        F.coalesce(F.sum(column(m)), F.lit(0)).alias(m)
        for m in metrics if m in present
    ]
    if not aggs:
        return df.select(*[column(k) for k in keys]).distinct()
    return df.groupBy(*[column(k) for k in keys]).agg(*aggs)


def ratio_of_sums(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """A-2: recompute a rate from summed parts; zero denominator → NULL."""
    return df.withColumn(out, kpi.ratio(num, den))
