"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Every row's number 0..n-1 (by ascending id) goes through a keyed Feistel
network over the smallest even-bit domain that holds n, walking the cycle
until the image is below n.  The image ``p`` is the row's place in the
shuffle: shard ``p mod k`` and slot ``p div k`` are computable for any row
number, the inverse gives the row at any place, shard sizes differ by at most
one and slots have no gaps.  No row is moved to decide this.

Law ``rows``: counts are at most one apart.  Copies of a text are spread like
any other rows, since one group may hold more rows than a shard.

Defined results: NULL text has 8 bytes and the CRC of the empty text; NULL
ids are numbered first; rows of one id (or NULL) that are much of the table are
numbered in pieces by their CRC; repeated rows each get a place of their own;
very long texts are measured in the scan and never moved; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import IdSlices

SHARDS, SEED, ROUNDS = 24, 20_260, 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """Round function: a 64-bit finaliser of the half block and the round key."""
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(_mix(np.array([seed + 1], np.uint64), 0x9E3779B97F4A7C15 * (r + 1) % 2**64)[0]) for r in range(ROUNDS)]


def permute(numbers: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """Images (or preimages) of ``numbers`` under the permutation of 0..n-1."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    x = numbers.astype(np.uint64)
    todo = np.arange(len(x))
    keys = _keys(seed)
    while len(todo):
        left, right = x[todo] >> half, x[todo] & mask
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (_mix(left, key) & mask), left
            else:
                left, right = right, left ^ (_mix(right, key) & mask)
        x[todo] = (left << half) | right
        todo = todo[x[todo] >= n]  # cycle walking: outside 0..n-1, go on
    return x.astype(np.int64)


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Id, size, CRC, shard and slot of every row; ``place`` is the place in the whole shuffle."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    slices = IdSlices(docs, id_col)
    n = slices.rows

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    placed = slices.numbered(rows, "doc_id", ["text_crc32", "size"], "row_number", F.shiftright("text_crc32", 24).cast("int")).withColumn("place", place("row_number"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"), F.expr(f"place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number", "place",
    )


__all__ = ["SEED", "SHARDS", "permute", "shard"]
