"""Joins on keys of which a few may hold much of the table.

The rows of a hot key are dealt over salts, and the key's one partner row is
put at every salt, so they meet in many tasks.  What is hot is known from
counts that the operators take anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key of more than one row in so many is hot; its rows are spread over so many salts.
HOT, SALTS = 1000, 64
#: Keys of fewer rows than this are never hot.
LEAST_HOT = 200


def hot_keys(counted: DataFrame, key: str, rows: int) -> list:
    """The keys of ``counted`` (key, n) with more than a ``HOT``-th of ``rows`` rows: at most ``HOT`` of them."""
    return [r[key] for r in counted.where(F.col("n") > max(rows // HOT, LEAST_HOT)).select(key).collect()]


def dealt(rows: DataFrame, key: str, hot: list, by: list[str]) -> DataFrame:
    """``rows`` with a ``salt``: by the hash of ``by`` for hot keys, 0 for others."""
    return rows.withColumn("salt", F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")).otherwise(0) if hot else F.lit(0))


def at_every_salt(rows: DataFrame, key: str, hot: list) -> DataFrame:
    """``rows`` at each salt that ``dealt`` rows of their key may have."""
    if not hot:
        return rows.withColumn("salt", F.lit(0))
    return rows.withColumn("salt", F.explode(F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))


__all__ = ["HOT", "LEAST_HOT", "SALTS", "at_every_salt", "dealt", "hot_keys"]
