"""Report tables: create, conform, append, overwrite, replace a slice or a range.

Tables are Parquet catalog tables partitioned by the report's date column
(a day, or the first of a month).  A slice (day or month) is a partition, so
replacing it is a dynamic partition overwrite: only the partitions present
in the batch are rewritten, in the same job that computes the batch.

Tables that ``jobs.load`` creates replace slices by a switch of folders
(``versions``), which readers see as old or new.  The functions here rewrite
partitions in place, for tables that were created otherwise: they write the
new partitions, then drop stale ones, so a crash between the two leaves extra
old days, never missing new ones, and a rerun gives the same table; a reader
of a slice that is being rewritten may fail or miss rows.
"""

from __future__ import annotations

import datetime as _dt
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import registry
from ..functions._util import column, quote

_SQL_TYPES = {"date": "DATE", "string": "STRING", "bigint": "BIGINT", "double": "DOUBLE"}


class SchemaMismatch(ValueError):
    """The batch does not have the table's columns."""


def ensure_table(spark: SparkSession, spec: registry.ReportSpec, table: str | None = None,
                 location: str | None = None, versioned: bool = False) -> str:
    """K-7: create the report table if absent; partitioned by its date column.

    The slices of a ``versioned`` table are replaced by a switch of folders
    (see ``sinks.versions``); the choice is a property of the table, made when
    it is created.

    A month grain needs no transform: monthly reports store the first day of
    the month, so identity partitioning gives one partition per month.
    """
    name = table or spec.table
    cols = ", ".join(f"{quote(f.name)} {_SQL_TYPES[f.dataType.simpleString()]}"
                     for f in spec.schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY ({quote(spec.partition_col)}){loc}"
              + (" TBLPROPERTIES ('slicewright.versioned' = 'true')" if versioned else ""))
    return name


def conform(df: DataFrame, spec: registry.ReportSpec, extra: str = "reject") -> DataFrame:
    """K-9: the batch with exactly the table's columns and types.

    Missing columns raise; extra columns raise (``extra="reject"``) or are
    dropped (``"drop"``).  REQUIRED columns are checked in-line: a NULL fails
    the write job itself (``raise_error``), before any partition is replaced,
    without a separate pass over the data.
    """
    present = set(df.columns)
    missing = [c for c in spec.columns if c not in present]
    if missing:
        raise SchemaMismatch(f"{spec.table}: missing columns {missing}")
    unknown = [c for c in df.columns if c not in set(spec.columns)]
    if unknown and extra == "reject":
        raise SchemaMismatch(f"{spec.table}: columns not in the table {unknown}")
    out = []
    for f in spec.schema.fields:
        c = column(f.name).cast(f.dataType)
        if f.name in spec.required:
            c = F.when(c.isNull(), F.raise_error(
                F.lit(f"{spec.table}: NULL in required column {f.name}")).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Column order of a catalog table (partition columns come last)."""
    return spark.table(table).columns


_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# The mode is a session setting: threads that share a session write one after the other.
_PINNED = threading.RLock()


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str | None):
    """Pin the partition overwrite mode for one write.  ``insertInto`` takes it
    from the session, not from writer options, and a cluster's default may be
    ``static`` (which would make a slice replace wipe the whole table)."""
    if mode is None:
        yield
        return
    with _PINNED:
        old = spark.conf.get(_OVERWRITE_MODE, None)
        spark.conf.set(_OVERWRITE_MODE, mode)
        try:
            yield
        finally:
            if old is None:
                spark.conf.unset(_OVERWRITE_MODE)
            else:
                spark.conf.set(_OVERWRITE_MODE, old)


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Slices that a task may write at once before it sorts the rest of its rows by slice.
OPEN_SLICES = 32
_WRITING: dict[SparkSession, int] = {}
_COUNTED = threading.Lock()


@contextmanager
def open_slices(spark: SparkSession):
    """Let a task keep ``OPEN_SLICES`` slices open while it writes.

    A prepared batch is clustered, so a task holds few slices: written side by
    side they need no sort, which would hold all rows of a long day's share in
    memory.  A number that the session has set itself stays.  Threads share the
    setting and do not wait for each other.
    """
    with _COUNTED:
        if spark in _WRITING or spark.conf.get(_WRITERS, None) is None:
            spark.conf.set(_WRITERS, str(OPEN_SLICES))
            _WRITING[spark] = _WRITING.get(spark, 0) + 1
            ours = True
        else:
            ours = False
    try:
        yield
    finally:
        with _COUNTED:
            if ours:
                _WRITING[spark] -= 1
                if not _WRITING[spark]:
                    del _WRITING[spark]
                    spark.conf.unset(_WRITERS)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def prepare(df: DataFrame, table: str) -> DataFrame:
    """The batch in the table's column order, clustered by its partition.

    Without the clustering every task writes a file into every day it holds
    (tasks x days small files on a long backfill).  REBALANCE lets AQE split
    a hot day into advisory-size files and merge small ones.  Anything
    observed on the returned frame runs in the write's result stage, where
    each partition's metrics count once even when a lost executor forces
    earlier stages to re-run.
    """
    spark = df.sparkSession
    out = df.select(*[column(c) for c in table_columns(spark, table)])
    parts = partition_columns(spark, table)
    return out.hint("rebalance", *parts) if parts else out


def _write(df: DataFrame, table: str, overwrite: bool, mode: str | None = None,
           prepared: bool = False) -> None:
    spark = df.sparkSession
    out = df if prepared else prepare(df, table)
    # an append needs no mode, and waits for nobody
    with overwrite_mode(spark, mode), open_slices(spark):
        out.write.insertInto(table, overwrite=overwrite)
    spark.catalog.refreshTable(table)


def append(df: DataFrame, table: str, prepared: bool = False) -> None:
    """K-1 / U-1: append rows (by column name; ``insertInto`` is positional)."""
    _write(df, table, overwrite=False, prepared=prepared)


def overwrite(df: DataFrame, table: str, prepared: bool = False) -> None:
    """K-2: replace the whole table."""
    _write(df, table, overwrite=True, mode="static", prepared=prepared)


def replace_slices(df: DataFrame, table: str, prepared: bool = False) -> None:
    """K-3 / K-4 / K-6: replace every partition (day or month) present in the
    batch; others stay.  A batch holding several months replaces all of them."""
    _write(df, table, overwrite=True, mode="dynamic", prepared=prepared)


def list_partitions(spark: SparkSession, table: str, lo=None, hi=None) -> list[str]:
    """Partition values of a table (catalog metadata only), those in ``[lo, hi]`` when given."""
    value = F.substring_index("partition", "=", -1)
    rows = spark.sql(f"SHOW PARTITIONS {table}").select(value.alias("v"))
    if lo is not None:
        rows = rows.where(F.col("v").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.col("v").between(str(lo), str(hi)))
    return [r.v for r in rows.collect()]


def drop_partitions(spark: SparkSession, table: str, col: str, values, batch: int = 500) -> None:
    """Remove partitions by value: their rows and their catalog entries.

    On a managed table ``DROP PARTITION`` deletes the files.  On an external
    table (``LOCATION``) it only forgets them, and a path read or a partition
    recovery would bring the old rows back, so their folders are removed
    through the table's file system first.
    """
    values = list(values)
    if not values:
        return
    if spark.catalog.getTable(table).tableType.upper() == "EXTERNAL":
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(described.first()["data_type"])
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for v in values:
            files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"{col}={v}"), True)
    for i in range(0, len(values), batch):
        specs = ", ".join(f"PARTITION ({quote(col)} = '{v}')" for v in values[i:i + batch])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    spark.catalog.refreshTable(table)


def stale_partitions(existing, written, lo, hi) -> list[str]:
    """Partitions inside ``[lo, hi]`` that the batch did not rewrite, in months of which it holds rows.

    A month without any incoming row is left as stored: an extract that
    brought nothing says nothing about what is there.
    """
    lo, hi = _dt.date.fromisoformat(str(lo)), _dt.date.fromisoformat(str(hi))
    written = {str(v) for v in written}
    months = {v[:7] for v in written}
    out = []
    for v in existing:
        try:
            d = _dt.date.fromisoformat(v)
        except ValueError:
            continue  # the NULL partition is never in a range
        if lo <= d <= hi and v[:7] in months and v not in written:
            out.append(v)
    return out


def replace_range(df: DataFrame, table: str, col: str, lo, hi, observation: Observation | None = None) -> dict:
    """K-5: replace the inclusive range ``[lo, hi]``, month by month.

    Dynamic overwrite rewrites the partitions the batch holds; in the months
    of which it holds rows, partitions of the range that it lacks are dropped
    afterwards (a day with no incoming rows ends up empty).  Months without
    rows stay as stored, so a range in one job and the same range in month
    chunks leave the same table.  The set of written partitions is observed
    during the write, so the batch is computed once.  An empty batch changes
    nothing.
    """
    spark = df.sparkSession
    if observation is None:  # else ``df`` is prepared and observes ``rows`` and ``slices``
        observation = Observation(f"replace_range_{table}")
        df = prepare(df, table).observe(observation, F.count(F.lit(1)).alias("rows"),
                                        F.collect_set(column(col).cast("string")).alias("slices"))
    replace_slices(df, table, prepared=True)
    got = observation.get
    rows = got.get("rows", 0) or 0
    dropped: list[str] = []
    if rows:
        dropped = stale_partitions(list_partitions(spark, table, lo, hi), got.get("slices") or [], lo, hi)
        drop_partitions(spark, table, col, dropped)
    return {"rows_written": int(rows), "dropped_partitions": dropped}


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a batch derived from the table it will replace: a
    reliable checkpoint in the shared ``spark.checkpoint.dir``."""
    return df.checkpoint(eager=True)
