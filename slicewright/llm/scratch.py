"""Intermediate tables in the shared checkpoint folder.

A written table cuts the lineage like a checkpoint does, survives lost
executors, and gives the planner the true size of what follows from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import checkpoint_dir, scratch_path, ship_package


def prepared(df: DataFrame) -> DataFrame:
    """``df``, once its session has a checkpoint folder and its workers have the package."""
    checkpoint_dir(df.sparkSession)
    ship_package(df.sparkSession)
    return df


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table under the checkpoint folder, read again."""
    path = scratch_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(columns: list[str]) -> list[str]:
    """Column names as Spark reads them whatever they hold, dots and backticks included."""
    return [f"`{c.replace('`', '``')}`" for c in columns]


__all__ = ["free", "prepared", "quoted", "written"]
