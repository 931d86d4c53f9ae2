"""Sinks: date-partitioned Parquet report tables."""

from .tables import (
    SchemaMismatch,
    append,
    conform,
    drop_partitions,
    ensure_table,
    list_partitions,
    materialize,
    overwrite,
    prepare,
    replace_range,
    replace_slices,
)

__all__ = ["SchemaMismatch", "append", "conform", "drop_partitions", "ensure_table", "list_partitions",
           "materialize", "overwrite", "prepare", "replace_range", "replace_slices"]
