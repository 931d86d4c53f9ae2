"""Ad hoc SQL (S-5) and report table scans (S-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import registry


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """S-5: run SQL over catalog tables, or over DataFrames passed by name
    (referenced as ``{name}`` in the text)."""
    return spark.sql(sql, **frames) if frames else spark.sql(sql)


def read_report(spark: SparkSession, report: str, path: str | None = None) -> DataFrame:
    """S-8: a report table, by catalog name or from its Parquet folder.

    The folder of a versioned table does not say which of its slices are
    current: such a table is read by name.
    """
    if path is not None:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_versions")
        if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            raise ValueError(f"{path} is a versioned table's folder: read the table by name")
        spec = registry.report(report)
        return spark.read.schema(spec.schema).parquet(path)
    name = registry.report(report).table if _known(report) else report
    return spark.table(name)


def _known(name: str) -> bool:
    try:
        registry.report(name)
        return True
    except KeyError:
        return False
