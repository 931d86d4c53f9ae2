"""Derived KPI view over the fill-rate table (F-16, F-17).

The stored table keeps the 0..1 ratio; percentages exist only in this view,
computed at read time (a projection over the partitioned table, so date
predicates on the view still prune partitions).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import registry


def create_kpi_view(spark: SparkSession, table: str | None = None, view: str | None = None,
                    temporary: bool = False) -> str:
    """Create (or replace) ``<table>_kpi`` with ``fill_rate_percent`` and
    ``serve_rate_percent`` beside the stored columns."""
    table = table or registry.REPORTS["fill_rate"].table
    view = view or f"{table}_kpi"
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"""
        CREATE OR REPLACE {kind} {view} AS
        SELECT *,
               try_divide(CAST(ad_server_impressions AS DOUBLE), CAST(ad_requests AS DOUBLE)) * 100.0
                 AS fill_rate_percent,
               try_divide(CAST(code_served_count AS DOUBLE), CAST(ad_requests AS DOUBLE)) * 100.0
                 AS serve_rate_percent
        FROM {table}""")
    return view
