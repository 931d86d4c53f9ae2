"""Slices replaced by a switch of folders: readers see the old slice or the new one.

A versioned table's slices (partitions) lie in folders of their own under
``_versions`` in the table's folder.  A replace writes the batch into a new
version folder, which no reader looks at, and then points the catalog's
partitions at it, one metadata change a slice; the old files stay where they
are.  A query that was planned before goes on reading them, one that is
planned later reads the new ones, and a job that dies at any point leaves each
slice whole, old or new: a rerun finishes the replace.

Slices that a range replace empties are pointed at an empty folder before
their partitions are dropped, so that dropping deletes nothing a reader holds.
``remove_old_versions`` deletes the folders that no partition uses any more.

Several slices are switched one after the other, so a reader of many slices
may see some old and some new.  Two jobs must not replace the same slice at a
time: the last switch wins.  Such a table is read by name; its folder alone
does not say which versions are current.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions._util import column, quote
from . import tables

PROPERTY = "slicewright.versioned"
FOLDER = "_versions"
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def is_versioned(spark: SparkSession, table: str) -> bool:
    return any(r.key == PROPERTY and r.value == "true" for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect())


def location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"].rstrip("/")


def _files(spark: SparkSession, path: str):
    """The path and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _partition(col: str, value: str) -> str:
    return f"PARTITION ({quote(col)} = {'NULL' if value == _NO_DATE else repr(value)})"


def _point_at(spark: SparkSession, table: str, col: str, value: str, folder: str) -> None:
    """One slice's switch: a single change in the catalog."""
    spark.sql(f"ALTER TABLE {table} {_partition(col, value)} SET LOCATION '{folder}'")


def _add(spark: SparkSession, table: str, col: str, folders: dict[str, str], batch: int = 500) -> None:
    """Slices that the table did not have, in few catalog calls."""
    items = sorted(folders.items())
    for k in range(0, len(items), batch):
        parts = " ".join(f"{_partition(col, v)} LOCATION '{folder}'" for v, folder in items[k:k + batch])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def write_version(df: DataFrame, table: str, col: str) -> str:
    """The prepared batch in a new version folder, by slice; nothing reads it yet."""
    folder = f"{location(df.sparkSession, table)}/{FOLDER}/{uuid.uuid4().hex}"
    with tables.open_slices(df.sparkSession):
        df.write.partitionBy(col).parquet(folder)
    return folder


def switch(spark: SparkSession, table: str, col: str, folder: str, slices, emptied=()) -> None:
    """Point the catalog at the version's slices, then drop the emptied ones."""
    existing = set(tables.list_partitions(spark, table))
    _add(spark, table, col, {v: f"{folder}/{col}={v}" for v in slices if v not in existing})
    for v in sorted(set(slices) & existing):
        _point_at(spark, table, col, v, f"{folder}/{col}={v}")
    for v in sorted(emptied):
        nothing = f"{folder}/_empty/{col}={v}"
        where, files = _files(spark, nothing)
        files.mkdirs(where)
        _point_at(spark, table, col, v, nothing)
    for v in sorted(emptied):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_partition(col, v)}")
    spark.catalog.refreshTable(table)


def observed(df: DataFrame, col: str, observation: Observation, *metrics) -> DataFrame:
    """A prepared batch that counts its rows and names its slices while it is written."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), F.collect_set(column(col).cast("string")).alias("slices"),
                      F.count_if(column(col).isNull()).alias("undated"), *metrics)


def replace(df: DataFrame, table: str, col: str, lo=None, hi=None, observation: Observation | None = None) -> dict:
    """K-3 … K-6, X11: replace the slices of the batch, or the inclusive range ``[lo, hi]`` of slices.

    With a range, its slices that the batch lacks are emptied, in the months of
    which it holds rows (see ``tables.stale_partitions``).  An empty batch
    changes nothing.  ``observation``, when given, is the one that ``df``
    reports to (``observed``).
    """
    spark = df.sparkSession
    if observation is None:
        observation = Observation(f"replace_{table}")
        df = observed(tables.prepare(df, table), col, observation)
    folder = write_version(df, table, col)
    got = observation.get
    rows = int(got.get("rows") or 0)
    if not rows:
        return {"rows_written": 0, "dropped_partitions": []}
    slices = [str(v) for v in got.get("slices") or []]
    emptied = tables.stale_partitions(tables.list_partitions(spark, table, lo, hi), slices, lo, hi) if lo is not None else []
    switch(spark, table, col, folder, slices + [_NO_DATE] * bool(got.get("undated")), emptied)
    return {"rows_written": rows, "dropped_partitions": emptied}


def versions_in_use(spark: SparkSession, table: str) -> set[str]:
    """Version folders that the table's current files lie in: one name a load, gathered on the executors from file names alone."""
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/{FOLDER}/([0-9a-f]+)/", 1)
    return {r[0] for r in spark.table(table).select(name.alias("version")).distinct().collect() if r[0]}


def remove_old_versions(spark: SparkSession, table: str, older_than: _dt.timedelta = _dt.timedelta(days=7)) -> list[str]:
    """Delete version folders that hold no current file and were written ``older_than`` ago or earlier.

    Give running readers and unfinished replaces that time.
    """
    used, removed = versions_in_use(spark, table), []
    where, files = _files(spark, f"{location(spark, table)}/{FOLDER}")
    if not files.exists(where):
        return removed
    limit = (_dt.datetime.now(_dt.timezone.utc) - older_than).timestamp() * 1000
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if name not in used and status.getModificationTime() <= limit:
            files.delete(status.getPath(), True)
            removed.append(name)
    return sorted(removed)
