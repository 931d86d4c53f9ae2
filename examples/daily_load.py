"""Daily load, end to end, on the shared test tables.

    python examples/daily_load.py [/root/testdata/sf0.01]

1. Land the fill-rate extract as JSON result pages, as the ad server's
   result pages would arrive.
2. Load the landing with the availableNow stream: here all files go in one
   micro-batch, which replaces every day it holds (slice replace).
3. Audit the table and reconcile it with the raw extract.

Everything is written under the session's checkpoint folder.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slicewright import registry  # noqa: E402
from slicewright.operators import reconcile  # noqa: E402
from slicewright.plans import jobs, reports  # noqa: E402
from slicewright.session import local_session, scratch_path  # noqa: E402
from slicewright.sinks import tables  # noqa: E402
from slicewright.sources import fixtures, pages  # noqa: E402

DIMS = ["DATE", "AD_UNIT_NAME"]
METRICS = ["UNFILLED_IMPRESSIONS", "CODE_SERVED_COUNT", "RESPONSES_SERVED", "AD_SERVER_IMPRESSIONS",
           "FILL_RATE", "AD_REQUESTS"]


def main(sf_dir: str) -> None:
    spark = local_session()
    raw = fixtures.raw_report(spark, sf_dir, "fill_rate")

    landing = scratch_path(spark, "example", "landing")
    pages.pages_from_rows(raw, DIMS, METRICS).select("rows").write.json(landing)
    table = "example_fill_rate_" + uuid.uuid4().hex[:8]
    tables.ensure_table(spark, registry.REPORTS["fill_rate"], table,
                        location=scratch_path(spark, "example", "tables"))
    landed = pages.flatten_pages(pages.read_pages(spark, landing), DIMS, METRICS)
    jobs.load(spark, "fill_rate", reports.report_fill_rate(landed), table=table, log_table=None)
    spark.catalog.refreshTable(table)
    print("rows loaded:", spark.table(table).count())

    jobs.audit(spark, "fill_rate", spark.table(table)).show(truncate=80)
    typed = reports.transform(raw, registry.REPORTS["fill_rate"])
    diff = reconcile.reconcile(typed, spark.table(table), ["date"], list(registry.FILL_RATE_SUM_COLUMNS),
                               only_differences=True)
    print("days that do not reconcile:", diff.count())


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
