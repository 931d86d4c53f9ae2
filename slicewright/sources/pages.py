"""Paged report results (S-1, S-2, G-2).

A landed result page holds rows; each row holds positional dimension values
and metric value groups.  Column ``i`` of the flat table is header ``i``,
headers being the dimensions followed by the metrics; only metric group 0 is
read.  Flattening is ``explode`` plus positional ``F.get`` per header: a
narrow, codegen-friendly projection, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import decode_dimension, decode_metric

DIMENSION_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
])
METRIC_VALUE = T.StructType([
    T.StructField("double_value", T.DoubleType()),
    T.StructField("int_value", T.LongType()),
])
ROW = T.StructType([
    T.StructField("dimension_values", T.ArrayType(DIMENSION_VALUE)),
    T.StructField("metric_value_groups", T.ArrayType(T.StructType([
        T.StructField("primary_values", T.ArrayType(METRIC_VALUE)),
    ]))),
])
PAGE_SCHEMA = T.StructType([T.StructField("rows", T.ArrayType(ROW))])


def read_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed result pages, read with the explicit page schema (no inference)."""
    return spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)


def flatten_pages(pages: DataFrame, dimensions, metrics, rows_col: str = "rows") -> DataFrame:
    """S-1 + G-2: one flat row per result row, one text column per header.

    A short row leaves the missing headers NULL; a row without metric groups
    leaves every metric NULL (S-2 decode rules in ``functions.coerce``).
    """
    rows = pages.select(F.explode(F.col(rows_col)).alias("r"))
    dims = F.col("r.dimension_values")
    values = F.get(F.col("r.metric_value_groups"), 0).getField("primary_values")
    return rows.select(
        *[decode_dimension(F.get(dims, i)).alias(name) for i, name in enumerate(dimensions)],
        *[decode_metric(F.get(values, i)).alias(name) for i, name in enumerate(metrics)],
    )


def _dimension_cell(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.struct(F.lit("").alias("string_value"), c.cast("bigint").alias("int_value"))
    return F.struct(F.coalesce(c.cast("string"), F.lit("")).alias("string_value"),
                    F.lit(0).cast("bigint").alias("int_value"))


def _metric_cell(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.struct(F.coalesce(c.cast("double"), F.lit(0.0)).alias("double_value"),
                        F.lit(0).cast("bigint").alias("int_value"))
    return F.struct(F.lit(0.0).alias("double_value"),
                    F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")).alias("int_value"))


def pages_from_rows(df: DataFrame, dimensions, metrics, page_size: int = 1000) -> DataFrame:
    """Encode flat rows as result pages of at most ``page_size`` rows.

    Used to land extracts and in tests.  Pages are cut inside each input
    partition (consecutive ids of one partition share a page), so every
    group is bounded by ``page_size`` whatever the data size.  A NULL source
    value becomes an unset scalar, as on the wire.
    """
    fields = {f.name: f for f in df.schema.fields}
    row = F.struct(
        F.array(*[_dimension_cell(fields[d]) for d in dimensions]).alias("dimension_values"),
        F.array(F.struct(F.array(*[_metric_cell(fields[m]) for m in metrics])
                         .alias("primary_values"))).alias("metric_value_groups"),
    )
    page_no = F.floor(F.monotonically_increasing_id() / F.lit(page_size))
    return (df.select(page_no.alias("page_no"), row.alias("row"))
            .groupBy("page_no")
            .agg(F.collect_list("row").alias("rows")))
