"""Table audit (A-3 … A-7, A-9, P-4, P-5, L-3, L-4).

The profile folds row count, NULL-date count and date coverage into one
aggregate, so one scan answers all three.  The distinct-date count is
planned as a two-level aggregate keyed on the date, so it needs no
collection of values anywhere.  Duplicate detection is a second pass:
a grouped count with a HAVING filter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import column


def audit_profile(df: DataFrame, date_col: str, table_name: str | None = None) -> DataFrame:
    """A-3 + A-4 + A-5 in one pass: total rows, NULL dates, min/max/distinct dates."""
    d = column(date_col)
    out = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(d.isNull()).alias("null_dates"),
        F.min(d).alias("min_date"),
        F.max(d).alias("max_date"),
        F.countDistinct(d).alias("unique_dates"),
    )
    if table_name is not None:
        out = out.select(F.lit(table_name).alias("table_name"), "*")
    return out


def audit_profiles(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """The profile of several tables, ``{name: (rows, date column)}``, one row each.

    The tables' dates are united under their table's name and aggregated
    together: one set of exchanges however many tables there are.  A table
    without rows keeps its row, from a marker that is not counted.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    parts = [df.select(F.lit(name).alias("table_name"), column(d).cast("date").alias("d"), F.lit(1).alias("real"))
             for name, (df, d) in tables.items()]
    parts.append(spark.createDataFrame([(name, None, 0) for name in tables], "table_name string, d date, real int"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("table_name").agg(
        F.count_if(F.col("real") == 1).alias("total_rows"),
        F.count_if(F.col("d").isNull() & (F.col("real") == 1)).alias("null_dates"),
        F.min("d").alias("min_date"), F.max("d").alias("max_date"), F.countDistinct("d").alias("unique_dates"))


def audit_duplicates(df: DataFrame, keys) -> DataFrame:
    """A-6 + P-5: key groups holding more than one row (NULL keys group together)."""
    return (df.groupBy(*[column(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("cnt"))
            .where(F.col("cnt") > 1))


def audit_duplicates_sets(df: DataFrame, key_sets) -> DataFrame:
    """A-6 for several keys in one scan.

    Output: the union of all key columns (NULL where a column is not part of
    that row's key), ``cnt``, and ``key_set`` = the index of the key in
    ``key_sets``.  Rows are counted once by all columns together; each key
    then sums those counts, so no row is doubled before an exchange.
    """
    cols: list[str] = []
    for ks in key_sets:
        cols += [c for c in ks if c not in cols]
    counted = df.groupBy(*[column(c) for c in cols]).agg(F.count(F.lit(1)).alias("cnt"))
    out = None
    for i, ks in enumerate(key_sets):
        whole = len(ks) == len(cols)
        g = counted if whole else counted.groupBy(*[column(c) for c in ks]).agg(F.sum("cnt").alias("cnt"))
        types = {f.name: f.dataType for f in counted.schema.fields}
        part = g.where(F.col("cnt") > 1).select(
            *[column(c) if c in ks else F.lit(None).cast(types[c]).alias(c) for c in cols], "cnt", F.lit(i).alias("key_set"))
        out = part if out is None else out.unionByName(part)
    return out


def top_duplicates(dups: DataFrame, keys, n: int = 5) -> DataFrame:
    """L-3: the ``n`` largest duplicate groups, in a total order."""
    order = [F.col("cnt").desc()] + [column(k).asc_nulls_first() for k in keys]
    return dups.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, keys, n: int = 3) -> DataFrame:
    """L-4: first ``n`` rows by a full key (deterministic sample)."""
    return df.orderBy(*[column(k).asc_nulls_first() for k in keys]).limit(n)


def sample_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """A-9: up to ``n`` distinct values of a column, smallest first."""
    return df.select(column(col)).distinct().orderBy(column(col).asc_nulls_first()).limit(n)


def audit_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A-7: one row per table with its row count, in one exchange of partial counts."""
    spark = next(iter(tables.values())).sparkSession
    out = spark.createDataFrame([(name, 0) for name in tables], "table_name string, real int")
    for name, df in tables.items():
        out = out.unionByName(df.select(F.lit(name).alias("table_name"), F.lit(1).alias("real")))
    return out.groupBy("table_name").agg(F.sum("real").cast("bigint").alias("row_count"))
