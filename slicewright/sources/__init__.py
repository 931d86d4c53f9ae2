"""Sources: landed result pages, CSV dumps, SQL and report tables, and the
raw extracts derived from the shared test tables."""

from .csv_dump import read_csv_dump, write_csv_dump
from .pages import PAGE_SCHEMA, flatten_pages, pages_from_rows, read_pages
from .tables import query, read_report

__all__ = ["PAGE_SCHEMA", "flatten_pages", "pages_from_rows", "query", "read_csv_dump", "read_pages",
           "read_report", "write_csv_dump"]
