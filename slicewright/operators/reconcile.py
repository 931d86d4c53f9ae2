"""Reconcile two versions of a report (C-7): by totals, and row by row.

Written as one union + one grouped aggregate instead of a join of two
aggregates: a single exchange on the keys, map-side partial sums (a hot key
costs one row per task), NULL keys compared as equal, and no join at all.

Row by row, each slice is summed up first by a checksum that does not depend
on the order of its rows; rows are compared only in slices whose checksums
differ, the others are pruned from both scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import column


def reconcile(a: DataFrame, b: DataFrame, keys, metrics, only_differences: bool = False) -> DataFrame:
    """Per key: each metric's sum in ``a`` and ``b``, their difference and a status.

    ``status`` is ``match``, ``mismatch``, ``only_a`` or ``only_b``.
    """
    def side(df, mine, other):
        cols = [column(k).alias(k) for k in keys]
        for m in metrics:
            cols.append(column(m).alias(f"{m}_{mine}"))
            cols.append(F.lit(None).cast(df.schema[m].dataType).alias(f"{m}_{other}"))
        cols += [F.lit(mine == "a").alias("in_a"), F.lit(mine == "b").alias("in_b")]
        return df.select(*cols)

    u = side(a, "a", "b").unionByName(side(b, "b", "a"))
    aggs = []
    for m in metrics:
        for s in ("a", "b"):
            aggs.append(F.coalesce(F.sum(f"{m}_{s}"), F.lit(0)).alias(f"{m}_{s}"))
    g = u.groupBy(*keys).agg(*aggs, F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b"))
    same = None
    for m in metrics:
        p = F.col(f"{m}_a").eqNullSafe(F.col(f"{m}_b"))
        same = p if same is None else same & p
    status = (F.when(~F.col("in_b"), "only_a")
              .when(~F.col("in_a"), "only_b")
              .when(same, "match")
              .otherwise("mismatch"))
    out = g.select(
        *keys,
        *[c for m in metrics for c in (F.col(f"{m}_a"), F.col(f"{m}_b"),
                                       (F.col(f"{m}_a") - F.col(f"{m}_b")).alias(f"{m}_delta"))],
        status.alias("status"),
    )
    return out.where(F.col("status") != "match") if only_differences else out


def checksum(df: DataFrame, columns=None) -> list[Column]:
    """Aggregates that are equal for equal multisets of rows: the count, and sums of both halves of row hashes.

    Halves are summed, so that no sum overflows below two billion rows a slice
    and repeated rows do not cancel out.  Columns are taken by name, in order.
    """
    h = F.xxhash64(*[column(c) for c in sorted(columns or df.columns)])
    return [F.count(F.lit(1)).alias("rows"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(h, 32)).alias("high")]


def differing_slices(a: DataFrame, b: DataFrame, slice_col: str) -> list:
    """The slices (days or months, NULL among them) whose rows differ in any way: few values, as metadata."""
    def side(df, mine):
        return df.groupBy(column(slice_col).alias("slice")).agg(*checksum(df)).withColumn("mine", F.lit(mine))

    both = side(a, 0).unionByName(side(b, 1))
    per = both.groupBy("slice").agg(F.count(F.lit(1)).alias("sides"), *[F.count_distinct(c).alias(c) for c in ("rows", "low", "high")])
    return [r["slice"] for r in per.where("sides < 2 or rows > 1 or low > 1 or high > 1").select("slice").collect()]


def reconcile_rows(a: DataFrame, b: DataFrame, slice_col: str) -> DataFrame:
    """C-7 row by row: the rows that ``a`` and ``b`` do not hold equally often.

    Output: the columns of ``a``, ``n_a`` and ``n_b`` (how often each side
    holds the row) and ``status`` (``only_a``, ``only_b`` or ``count``).
    Types follow ``a``.  Two scans: one for checksums, and one of the slices
    that differ, whose rows are counted once by all their columns (a row that
    is repeated often costs one row per task).
    """
    if set(a.columns) != set(b.columns):
        raise ValueError(f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}")
    b = b.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in a.schema.fields])
    slices = differing_slices(a, b, slice_col)
    key = column(slice_col)
    within = key.isin([s for s in slices if s is not None])
    if None in slices:
        within = within | key.isNull()
    cols = [column(c) for c in a.columns]
    sided = a.where(within).select(*cols, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.where(within).select(*cols, F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
    counted = sided.groupBy(*cols).agg(F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b")).where("n_a <> n_b")
    return counted.withColumn("status", F.when(F.col("n_b") == 0, "only_a").when(F.col("n_a") == 0, "only_b").otherwise("count"))
