"""Set algebra of loads (U-1, U-2, U-3) with the slice predicates (P-2, P-3).

These are the query forms of the sinks: what a table holds after an append
or a slice replace.  ``sinks.tables`` performs the same change physically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import column


def append_union(*frames: DataFrame) -> DataFrame:
    """U-1 / U-3: bag union by column name (append, or month chunks)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def not_in_slice(pred):
    """Complement of a slice predicate that keeps rows where it is NULL (P-2)."""
    return ~F.coalesce(pred, F.lit(False))


def replace_slice(stored: DataFrame, batch: DataFrame, col: str, values=None) -> DataFrame:
    """U-2 / K-3 / K-4 / K-6: (stored − slices) ∪ batch.

    The slices are ``values`` when given, else every value of ``col`` in the
    batch (all its days or months, not only the first row's).  Stored rows
    with a NULL slice value are never removed.  The slice keys are one row per
    day or month, so the anti-join's build side stays small.
    """
    if values is not None:
        kept = stored.where(not_in_slice(column(col).isin(list(values))))
    else:
        keys = batch.select(column(col).alias(col)).where(column(col).isNotNull()).distinct()
        kept = stored.join(keys, on=col, how="left_anti")
    return kept.unionByName(batch.select(*stored.columns))


def replace_range(stored: DataFrame, batch: DataFrame, col: str, lo, hi) -> DataFrame:
    """U-2 / K-5 / P-3: (stored − [lo, hi]) ∪ batch; a day of the range with no
    incoming rows ends up empty."""
    in_range = column(col).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return stored.where(not_in_slice(in_range)).unionByName(batch.select(*stored.columns))
