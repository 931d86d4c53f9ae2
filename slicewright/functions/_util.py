from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def quote(name: str) -> str:
    """Backtick-quote a column name (CSV headers hold dots and spaces)."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quote(name))
