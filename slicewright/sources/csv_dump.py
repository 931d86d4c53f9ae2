"""CSV report dumps (S-4).

A dump has one header line with names such as ``Dimension.DATE``,
``Column.AD_SERVER_IMPRESSIONS`` or ``Ad unit 1``; no properties block, no
totals row.  Columns are found by name: files are grouped by their header
line, which the executors read, each group is read with its own header as
schema, and the groups are united by name.  Every column is read as text and typed later by the report
pipeline, so a bad value in one column cannot fail the scan, and the text
``NA`` (a country code) stays text in dimension columns.

Quotes are doubled inside quoted values, which may hold line breaks; a file is
therefore read by one task (land large dumps as several files).  A row with
more or fewer values than its header fails the read.
"""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import column


def dump_headers(spark: SparkSession, path: str) -> DataFrame:
    """(header, file) of a landing: the first line of each file, found by the executors.

    Rows of a file's first block carry a rising number within their task, so
    the least one is the header.  Lines are known by their hash until the
    headers are found: least numbers take a few bytes a file, while texts
    would have every task sort all its lines.  No file is opened on the
    driver; an empty file has no line and is left out.
    """
    lines = spark.read.text(path).select(
        "value", F.xxhash64("value").alias("line_hash"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begins"), F.monotonically_increasing_id().alias("n"))
    lines = lines.where("begins = 0")
    firsts = lines.groupBy("file").agg(F.min_by("line_hash", "n").alias("line_hash"))
    texts = lines.join(F.broadcast(firsts.select("line_hash").distinct()), "line_hash", "left_semi").select("line_hash", "value").distinct()
    return firsts.join(F.broadcast(texts), "line_hash").select(F.regexp_replace("value", "^\ufeff", "").alias("header"), "file")


def read_csv_dump(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Read one or many dump files; all columns are strings, matched by header name.

    ``columns`` selects header names (NULL where a file lacks one); otherwise
    all names of all files are returned.
    """
    found = dump_headers(spark, path).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # distinct headers are few; where there is one, the landing is read as a whole and no file name reaches the driver
        lines = sorted(r["header"] for r in found.select("header").distinct().collect() if r["header"])
        groups = [path] if len(lines) == 1 else [[unquote(r["file"]) for r in found.where(F.col("header") == line).select("file").collect()] for line in lines]
    finally:
        found.unpersist()
    out, headers = None, [tuple(next(csv.reader([line]))) for line in lines]
    for names, files in zip(headers, groups):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        reader = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
                  .option("escape", '"').option("multiLine", True))
        if not set("*?[{") & set(path):  # folders named column=value below the landing are columns
            reader = reader.option("basePath", path)
        part = reader.csv(files)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or ()]))
    if columns is None:
        return out
    folders = [c for c in out.columns if c not in {n for names in headers for n in names}]
    missing = T.StructType([T.StructField(c, T.StringType()) for c in columns if c not in out.columns])
    if missing:
        out = out.unionByName(spark.createDataFrame([], missing), allowMissingColumns=True)
    return out.select(*[column(c) for c in [*columns, *folders]])


def write_csv_dump(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write rows as a dump (header line, text values, empty = missing),
    optionally one folder per value of ``partition_by`` (e.g. per month)."""
    w = df.write.mode("overwrite").option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)
