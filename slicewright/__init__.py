"""slicewright: ad-delivery report tables on Spark.

Raw report extracts (paged results or CSV dumps) are typed and deduplicated
with native Spark expressions, queried by dimension and date range, written
into date-partitioned Parquet tables slice by slice, backfilled over long
periods and audited.
"""

from . import registry

__all__ = ["registry"]
