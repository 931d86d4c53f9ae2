"""Global row numbers and range parts over an integer id, without a global sort.

The id range is cut into ``GRAIN`` equal slices and the rows of each slice are
counted, so the driver holds a bounded number of counters whatever the table's
size.  Where ids are clustered (one far id is enough), slices that hold many
rows are cut further, in proportion to their rows, until none does.  Row
numbers are the slice's offset plus the rank within the slice; parts are runs
of slices with about the same number of rows.  Both depend on the rows alone,
not on files, splits or the cluster, so a rerun after a lost executor gives
the same numbers.  Rows that share one id stay in one part; they are numbered
in pieces if they are much of the table.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of the id range.
GRAIN = 16_384
#: A slice with more rows than this, and than 16 times the average, is cut further, at most so many times.
MANY, LEVELS = 10_000, 6
#: A single id with more than one row in so many is ranked in ``PIECES`` pieces: at most ``GRAIN`` counters in all.
HOT_ID, PIECES = 64, 256


#: Stands for a NULL id where ids are compared; NULL ids come first.
NO_ID = -(1 << 63)


def _div(a: int, b: int) -> int:
    """Integer division as SQL has it, towards zero."""
    return a // b if a >= 0 else -(-a // b)


class IdSlices:
    """Slices of ``df`` by the integer column ``id_col``; NULL ids form the first slice."""

    def __init__(self, df: DataFrame, id_col: str):
        ids = df.select(F.col(id_col).cast("long").alias("id"))
        low, high = ids.agg(F.min("id"), F.max("id")).first()
        low, high = (0, 0) if low is None else (low, high)
        self.width = (high - low) // (GRAIN - 1) + 1
        self.base = _div(low, self.width) - 1
        self.starts: list[int] = []  # of the slices, where equal ones would be uneven
        self._count(ids)
        for _ in range(LEVELS):
            if not self._cut_further():
                break
            self._count(ids)

    def _count(self, ids: DataFrame) -> None:
        found = ids.groupBy(self.of("id").alias("slice")).agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last")).collect()
        size = len(self.starts) + 1 if self.starts else GRAIN + 2
        self.counts, self.firsts, self.lasts = [0] * size, [NO_ID] * size, [NO_ID] * size
        for r in found:
            self.counts[r["slice"]] = r["n"]
            if r["first"] is not None:
                self.firsts[r["slice"]], self.lasts[r["slice"]] = r["first"], r["last"]
        self.offsets = [0, *accumulate(self.counts)]
        self.rows = self.offsets.pop()

    def _cut_further(self) -> bool:
        """Cut slices with many rows into pieces by their share of the rows; whether any was cut."""
        many = max(MANY, 16 * self.rows // GRAIN)
        used = [(a, b + 1, n) for a, b, n in zip(self.firsts[1:], self.lasts[1:], self.counts[1:]) if n]
        if not any(n > many and b - a > 1 for a, b, n in used):
            return False
        starts, cut = [], False
        for a, b, n in used:
            pieces = min(b - a, 1 + GRAIN * n // self.rows) if n > many else 1
            starts += sorted({a + j * (b - a) // pieces for j in range(pieces)})
            cut |= pieces > 1
        self.starts = starts
        return cut

    def of(self, id_col: str) -> Column:
        """Slice of a row: 0 for NULL, else 1.. in ascending order of the id."""
        if not self.starts:
            return F.coalesce(F.expr(f"(cast(`{id_col}` as bigint) div {self.width}L) - ({self.base}L)"), F.lit(0)).cast("int")
        # the number of starts that are not above the id, by halving steps
        steps = [1 << k for k in reversed(range(len(self.starts).bit_length()))]
        starts, c = F.split(F.lit(",".join(map(str, self.starts))), ",").cast("array<bigint>"), F.col(id_col).cast("long")
        return F.when(c.isNull(), 0).otherwise(F.aggregate(
            F.array(*map(F.lit, steps)), F.lit(0),
            lambda at, step: F.when(F.coalesce(F.get(starts, at + step - 1) <= c, F.lit(False)), at + step).otherwise(at)))

    def hot(self) -> list[int]:
        """Slices of a single id, or of NULL, that hold much of the table: at most ``HOT_ID``."""
        many = max(MANY, self.rows // HOT_ID)
        return [k for k, (n, a, b) in enumerate(zip(self.counts, self.firsts, self.lasts)) if n > many and a == b]

    def numbered(self, df: DataFrame, id_col: str, ties: list[str], name: str, piece: Column | None = None) -> DataFrame:
        """``df`` with its row number 0.. by ascending id, then ``ties``, as ``name``.

        Rows equal in the id and all ``ties`` are interchangeable.  A slice is
        ranked in one task, so give only the columns that are needed.  ``piece``
        (0 to ``PIECES`` - 1, never falling as the ``ties`` ascend) cuts the rows
        of an id that holds much of the table, or of NULL, into several tasks.
        """
        slice_, order = self.of(id_col), [F.col(id_col).asc_nulls_first(), *ties]
        hot = self.hot()
        if piece is None or not hot:
            return df.withColumn(name, element(self.offsets, slice_) + F.row_number().over(Window.partitionBy(slice_).orderBy(*order)) - 1)
        part = F.when(slice_.isin(hot), piece).otherwise(0)
        found = df.where(slice_.isin(hot)).groupBy(slice_.alias("slice"), piece.alias("piece")).agg(F.count("*").alias("n")).collect()
        counts = {(r["slice"], r["piece"]): r["n"] for r in found}
        before = [b for k in hot for b in accumulate((counts.get((k, j), 0) for j in range(PIECES - 1)), initial=0)]
        at = F.array_position(F.array(*map(F.lit, hot)), slice_).cast("int")  # from 1; 0 for the other slices
        earlier = F.when(at > 0, element(before, (at - 1) * PIECES + part)).otherwise(0)
        return df.withColumn(name, element(self.offsets, slice_) + earlier + F.row_number().over(Window.partitionBy(slice_, part).orderBy(*order)) - 1)

    def parts(self, n: int) -> tuple[list[int], list[int]]:
        """Part 0.. of each slice, for at most about ``n`` parts of near-equal rows, and each part's first id."""
        share = max(1, -(-self.rows // max(1, n)))
        of_slice, heads, last = [], [], -1
        for offset, count, first in zip(self.offsets, self.counts, self.firsts):
            if count and offset // share != last:
                last = offset // share
                heads.append(first)
            of_slice.append(max(0, len(heads) - 1))
        return of_slice, heads


def element(values: list[int], index: Column) -> Column:
    """``values[index]``, a lookup in a constant array of at most ``GRAIN`` + 2 numbers."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"), index)


__all__ = ["GRAIN", "NO_ID", "PIECES", "IdSlices", "element"]
