"""Jobs: load one report batch (C-1), backfill a period (C-3), audit (C-5, C-6).

Everything up to the write is lazy; each load is one Spark job that computes
the batch and writes it, with row counts taken by an ``Observation`` during
that job (K-12) instead of a second pass.  Only metadata reaches the driver:
counts, the written slice keys, three sample rows on a dry run.
"""

from __future__ import annotations

import datetime as _dt
import functools
import inspect
import traceback

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import registry
from ..operators import audit as audit_ops
from ..operators import calendar
from ..operators import reconcile as reconcile_ops
from ..operators.report_query import range_predicate
from ..sinks import tables, versions
from . import reports

LOAD_LOG_TABLE = "load_log"
LOAD_LOG_SCHEMA = T.StructType([
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("severity", T.StringType()),
    T.StructField("report_type", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("slice_start", T.DateType()),
    T.StructField("slice_end", T.DateType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("null_metric_values", T.LongType()),
    T.StructField("coerced_to_null", T.LongType()),
    T.StructField("coerced_by_column", T.MapType(T.StringType(), T.LongType())),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
])


def log_load(spark: SparkSession, record: dict, table: str = LOAD_LOG_TABLE) -> None:
    """K-13: append one record to the run log table (absent fields are NULL)."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ("
        + ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in LOAD_LOG_SCHEMA.fields)
        + ") USING parquet")
    stored = spark.table(table).columns
    new = [f for f in LOAD_LOG_SCHEMA.fields if f.name not in stored]
    if new:  # a log begun before these fields existed
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in new)})")
    row = {f.name: record.get(f.name) for f in LOAD_LOG_SCHEMA.fields}
    row["logged_at"] = row["logged_at"] or _dt.datetime.now(_dt.timezone.utc)  # an instant, not a wall-clock time
    spark.createDataFrame([row], LOAD_LOG_SCHEMA).select(*spark.table(table).columns).write.insertInto(table)


def load(
    spark: SparkSession,
    report: str,
    batch: DataFrame,
    mode: str = "slice",
    start=None,
    end=None,
    table: str | None = None,
    dry_run: bool = False,
    extra_columns: str = "reject",
    log_table: str | None = LOAD_LOG_TABLE,
    materialize: bool = False,
    fetched: Observation | None = None,
    coerced: Observation | None = None,
    versioned: bool = True,
) -> dict:
    """C-1: write a typed report batch into its table.

    ``mode``: ``slice`` (replace every day/month present, K-3/K-4/K-6),
    ``range`` (replace ``[start, end]``, K-5), ``append`` (K-1) or
    ``overwrite`` (K-2).  An empty batch deletes and writes nothing and
    succeeds with 0 rows (K-10).  ``dry_run`` writes nothing and returns the
    count, three sample rows and, as a DataFrame, the slices a load would
    change (K-11).  ``fetched`` observes ``rows`` of the raw extract, and
    ``coerced`` the values of each column that had a text but no number (as
    the pipelines do with ``coerced=``), for the log (K-13); both are filled
    by the write itself.  ``materialize`` checkpoints the
    batch first (into ``spark.checkpoint.dir``): needed when the batch is
    derived from the table it replaces.  A table that this load creates is
    ``versioned`` by default: slices and ranges are replaced by a switch that
    readers see as old or new (X11, ``sinks.versions``).
    """
    spec = registry.report(report)
    name = table or spec.table
    conformed = tables.conform(batch, spec, extra=extra_columns)
    if materialize and not dry_run:
        conformed = tables.materialize(conformed)
    result = {"report_type": spec.name, "table": name, "mode": mode}

    if dry_run:
        sums = slice_sums(spec, conformed)
        found = sums.agg(F.sum("rows").alias("rows"), F.slice(F.sort_array(F.collect_list("first_row")), 1, 3).alias("sample")).first()
        out = {**result, "status": "DRY_RUN", "rows": int(found["rows"] or 0), "sample": [r.asDict() for r in found["sample"]]}
        if spark.catalog.tableExists(name):
            out["diff"] = compare_with_stored(spark, spec, sums, name)
        return out

    tables.ensure_table(spark, spec, name, versioned=versioned)
    if mode == "overwrite" and conformed.isEmpty():
        # A static overwrite with no rows would empty the table; the other
        # modes write nothing for an empty batch by themselves.
        result.update(status="SUCCESS", rows_inserted=0, message="No data available")
        if log_table:
            log_load(spark, {"severity": "WARNING", "report_type": spec.name, "table_name": name, "mode": mode,
                             "rows_written": 0, "status": "SUCCESS", "message": result["message"]}, log_table)
        return result
    metrics = [f.name for f in spec.schema.fields if f.name not in spec.required
               and not isinstance(f.dataType, (T.StringType, T.DateType))]
    null_count = sum((F.count_if(F.col(m).isNull()) for m in metrics), F.lit(0)) if metrics else F.lit(0)
    obs = Observation(f"load_{name}")
    record = {"severity": "INFO", "report_type": spec.name, "table_name": name, "mode": mode,
              "slice_start": _as_date(start), "slice_end": _as_date(end)}
    if mode == "range" and start is not None and end is not None:
        # Rows outside the range would rewrite slices nobody asked to replace:
        # fail the job in-line, before anything is committed.
        lo, hi = _as_date(start), _as_date(end)
        first = _first_slice(spec, lo)
        key = F.col(spec.partition_col)
        conformed = conformed.withColumn(spec.partition_col, F.when(
            key.between(F.lit(first), F.lit(hi)), key).otherwise(F.raise_error(F.lit(
                f"{name}: row outside the range {first} .. {hi}")).cast("date")))
    # Observed after the rebalance: the counts are taken in the write stage.
    prepared = tables.prepare(conformed, name)
    try:
        if mode == "range" and (start is None or end is None):
            raise ValueError("range mode needs start and end")
        if mode in ("slice", "range") and versions.is_versioned(spark, name):
            bounds = (start, end) if mode == "range" else ()
            out = versions.replace(versions.observed(prepared, spec.partition_col, obs, null_count.alias("nulls")), name, spec.partition_col, *bounds, observation=obs)
            if bounds:
                result["dropped_partitions"] = out["dropped_partitions"]
        elif mode == "range":
            observed = prepared.observe(obs, F.count(F.lit(1)).alias("rows"),
                                        null_count.alias("nulls"),
                                        F.collect_set(F.col(spec.partition_col).cast("string")).alias("slices"))
            out = tables.replace_range(observed, name, spec.partition_col, start, end, observation=obs)
            result["dropped_partitions"] = out["dropped_partitions"]
        else:
            observed = prepared.observe(obs, F.count(F.lit(1)).alias("rows"), null_count.alias("nulls"))
            if mode == "slice":
                tables.replace_slices(observed, name, prepared=True)
            elif mode == "append":
                tables.append(observed, name, prepared=True)
            elif mode == "overwrite":
                tables.overwrite(observed, name, prepared=True)
            else:
                raise ValueError(f"unknown load mode {mode!r}")
        got = obs.get
        rows = int(got.get("rows") or 0)
        result.update(status="SUCCESS", rows_inserted=rows)
        if rows == 0:
            result["message"] = "No data available"
        record.update(rows_written=rows, null_metric_values=int(got.get("nulls") or 0), status="SUCCESS",
                      message=result.get("message"))
        if fetched is not None and rows:  # Spark drops the observation with an empty plan
            record["rows_read"] = result["rows_read"] = int(fetched.get.get("rows") or 0)
        if coerced is not None and rows:
            by_column = {k: int(v or 0) for k, v in sorted(coerced.get.items())}
            record["coerced_by_column"] = result["coerced_by_column"] = by_column
            record["coerced_to_null"] = result["coerced_to_null"] = sum(by_column.values())
    except Exception as e:
        record.update(severity="ERROR", status="FAILED", message=str(e))
        if log_table:
            log_load(spark, record, log_table)
        raise
    if log_table:
        log_load(spark, record, log_table)
    return result


def _metrics(spec: registry.ReportSpec) -> list[str]:
    return [f.name for f in spec.schema.fields if isinstance(f.dataType, T.LongType) and f.name not in spec.required]


def slice_sums(spec: registry.ReportSpec, batch: DataFrame) -> DataFrame:
    """One row per slice of a batch: rows, metric sums and its first row, checkpointed.

    All that a dry run says comes from these few rows, so the batch is computed once.
    """
    return batch.groupBy(spec.partition_col).agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.struct(*spec.columns)).alias("first_row"), *[F.sum(m).alias(m) for m in _metrics(spec)],
    ).checkpoint()


def compare_with_stored(spark: SparkSession, spec: registry.ReportSpec, sums: DataFrame,
                        table: str) -> DataFrame:
    """C-7 before a reload: per slice, the batch's metric sums (``slice_sums``)
    against what the table holds for the same slices; only slices that differ
    are returned.

    The stored side is cut to the batch's slices with a semi-join on the
    slice keys (one row per day or month).
    """
    key = spec.partition_col
    stored = spark.table(table).join(sums.select(key), key, "left_semi")
    return reconcile_ops.reconcile(stored, sums, [key], _metrics(spec), only_differences=True)


def _first_slice(spec: registry.ReportSpec, lo: _dt.date) -> _dt.date:
    """The first slice key of a range: a monthly report's is the first of its month."""
    return lo.replace(day=1) if spec.partition_col == "report_date" else lo


def _as_date(v):
    if v is None or isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v))


# -- backfill (C-3) ------------------------------------------------------------

# Raw date columns and their encodings, in order of preference: API and paged
# extracts, CSV dumps (daily, then monthly), and dumps landed by month folder.
CHUNK_FOLDER = "chunk_start"
_RAW_DATES = (("DATE", "date_int"), ("MONTH_YEAR", "month_year"), ("Dimension.DATE", "iso"),
              ("Dimension.MONTH_YEAR", "month_year"), (CHUNK_FOLDER, "folder"))


def _raw_date(raw: DataFrame) -> tuple[str, str] | None:
    for name, encoding in _RAW_DATES:
        if name in raw.columns:
            if encoding == "folder":
                encoding = "iso" if isinstance(raw.schema[name].dataType, T.StringType) else "date"
            return name, encoding
    return None


def _typed(pipe, raw: DataFrame, lo: _dt.date, hi: _dt.date, coerced: Observation | None) -> DataFrame:
    """The raw rows of a chunk through its pipeline, which reports to ``coerced`` if given.

    A dump that names no month is dated by its chunk: by its month folder, or,
    for a chunk within one month, by that month's first day.
    """
    takes = inspect.signature(pipe).parameters
    if coerced is not None:
        pipe = functools.partial(pipe, coerced=coerced)
    if "report_date" not in takes or {"MONTH_YEAR", "Dimension.MONTH_YEAR"} & set(raw.columns):
        return pipe(raw)
    if CHUNK_FOLDER in raw.columns:
        return pipe(raw, report_date=F.trunc(F.col(CHUNK_FOLDER).cast("string").cast("date"), "MM"))
    if (lo.year, lo.month) != (hi.year, hi.month):
        raise ValueError("rows without a month: land them by month folder (chunk_start=...), give a function of "
                         "(first day, last day), or backfill one month")
    return pipe(raw, report_date=lo.replace(day=1))


LEDGER = "report_type string, table_name string, chunk_start date, chunk_end date, fingerprint string, rows bigint, finished_at timestamp"


def fingerprint(raw: DataFrame) -> str:
    """What the rows of an extract are, whatever their order: columns, count and hash sums."""
    rows = raw.agg(*reconcile_ops.checksum(raw)).first()
    return ":".join(str(x) for x in (",".join(f"{c} {t}" for c, t in sorted(raw.dtypes)), rows["rows"], rows["low"] or 0, rows["high"] or 0))


def finished_chunks(spark: SparkSession, ledger: str, report: str, table: str) -> dict:
    """{(first day, last day): (fingerprint, rows)} of the chunks last finished; none if the table is gone."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger} ({LEDGER}) USING parquet")
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.table(ledger).where((F.col("report_type") == report) & (F.col("table_name") == table))
    last = rows.groupBy("chunk_start", "chunk_end").agg(F.max_by(F.struct("fingerprint", "rows"), "finished_at").alias("f"))
    return {(r["chunk_start"], r["chunk_end"]): (r["f"]["fingerprint"], r["f"]["rows"]) for r in last.collect()}  # a row a chunk


def _finish_chunk(spark: SparkSession, ledger: str, report: str, table: str, lo, hi, found: str, rows: int) -> None:
    now = _dt.datetime.now(_dt.timezone.utc)
    spark.createDataFrame([(report, table, lo, hi, found, rows, now)], LEDGER).coalesce(1).write.insertInto(ledger)
    spark.catalog.refreshTable(ledger)


def backfill(
    spark: SparkSession,
    report: str,
    raw,
    start,
    end,
    chunked: bool = False,
    table: str | None = None,
    dry_run: bool = False,
    pipeline=None,
    log_table: str | None = LOAD_LOG_TABLE,
    ledger: str | None = None,
) -> dict:
    """C-3: load ``[start, end]`` of a report from a raw extract.

    ``raw`` is a landed extract (pages, API rows, CSV or legacy dumps), or a
    function ``(first day, last day) -> extract`` that is asked month by month.
    By default one job replaces the whole range; ``chunked=True`` (always so
    for a function) replaces month by month, stopping at the first error:
    finished months stay, and a rerun of the same range is idempotent.  Both
    leave the same table: a month without rows is left as stored (K-10).
    Returns per-chunk rows and the running total (A-8).

    ``ledger`` names a table of finished chunks with the fingerprint of their
    raw rows (it makes the backfill chunked): a rerun skips chunks whose input
    is as it was, at the price of one scan for the fingerprint, so a broken
    backfill goes on where it stopped.  The ledger knows only of its own
    backfills: leave it out after the table was changed by other means.
    """
    spec = registry.report(report)
    pipe = pipeline or reports.LEGACY_PIPELINES.get(spec.name) or reports.REPORT_PIPELINES[spec.name]
    chunks = [(_as_date(start), _as_date(end))]
    if chunked or callable(raw) or ledger:
        chunks = [(r.month_start, r.month_end) for r in calendar.month_ranges(spark, start, end).orderBy("chunk").collect()]
    summary, total = [], 0
    name = table or spec.table
    done = finished_chunks(spark, ledger, spec.name, name) if ledger and not dry_run else {}
    for lo, hi in chunks:
        part = raw(lo, hi) if callable(raw) else raw
        if part is None:
            continue
        first = _first_slice(spec, lo)
        found = _raw_date(part)
        if found:  # pushed to the landing scan
            part = part.where(range_predicate(part, found[0], first, hi, found[1]))
        found_print = fingerprint(part) if ledger else None
        if found_print is not None and done.get((lo, hi), (None, 0))[0] == found_print:
            n = done[lo, hi][1]
            total += n
            summary.append({"month_label": lo.strftime("%B %Y"), "start": lo, "end": hi, "rows": n, "running_total": total, "status": "SKIPPED"})
            continue
        fetched = Observation(f"fetched_{spec.table}")
        part = part.observe(fetched, F.count(F.lit(1)).alias("rows"))
        # A landed extract may hold more than the range: keep only its slices
        # (a monthly slice is keyed by the first of its month).
        coerced = Observation(f"coerced_{spec.table}") if "coerced" in inspect.signature(pipe).parameters else None
        batch = _typed(pipe, part, lo, hi, coerced)
        batch = batch.where(F.col(spec.partition_col).between(F.lit(first), F.lit(hi)))
        res = load(spark, spec.name, batch, mode="range", start=lo, end=hi, table=table,
                   dry_run=dry_run, log_table=log_table, extra_columns="drop", fetched=fetched, coerced=coerced)
        n = res.get("rows_inserted", res.get("rows", 0))
        total += n
        if ledger and not dry_run:
            _finish_chunk(spark, ledger, spec.name, name, lo, hi, found_print, n)
        summary.append({"month_label": lo.strftime("%B %Y"), "start": lo, "end": hi,
                        "rows": n, "running_total": total, "status": res["status"]})
    return {"report_type": spec.name, "chunks": summary, "total_rows": total, "status": "SUCCESS"}


BACKFILL_DEFAULT_REPORTS = ("inventory_daily", "fill_rate", "geo_monthly")


def backfill_reports(spark: SparkSession, raws: dict, start, end, reports_=BACKFILL_DEFAULT_REPORTS,
                     **kwargs) -> list[dict]:
    """C-3 over several reports, in order; the first failure stops the run
    (what was loaded before it stays).  ``raws`` maps report name → raw
    extract (and ``pipelines`` may map report name → pipeline)."""
    pipelines = kwargs.pop("pipelines", {})
    out = []
    for name in reports_:
        if name not in raws:
            out.append({"report_type": name, "status": "SKIPPED", "message": "no raw extract given"})
            continue
        out.append(backfill(spark, name, raws[name], start, end, pipeline=pipelines.get(name), **kwargs))
    return out


# -- audit (C-5, C-6) ------------------------------------------------------------

FINDINGS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("value", T.LongType()),
    T.StructField("detail", T.StringType()),
])


def _row_text(columns) -> Column:
    """A row as ``column=value, ...``, NULL as such."""
    return F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in columns])


def _findings(spark: SparkSession, table: str, spec: registry.ReportSpec, df: DataFrame, profile: dict, duplicates: int, largest: list[str], full: int) -> DataFrame:
    """The findings of one table; the sample is read from the earliest date's slice alone."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' not null'}" for f in df.schema.fields)
    lo, hi, dates_ = profile["min_date"], profile["max_date"], profile["unique_dates"]
    out = [(table, "schema", "INFO", len(df.columns), schema), (table, "total_rows", "INFO", profile["total_rows"], None),
           (table, "date_range", "INFO", dates_, f"{lo} .. {hi} ({dates_} distinct)"),
           (table, "null_dates", "WARNING" if profile["null_dates"] else "OK", profile["null_dates"], None),
           (table, "duplicates", "WARNING" if duplicates else "OK", duplicates, "; ".join(largest) or None)]
    full_key = registry.FULL_DUPLICATE_KEYS.get(spec.name)
    if full_key:
        out.append((table, "duplicates_full_key", "WARNING" if full else "OK", full, ", ".join(full_key)))
    first = df.where(F.col(spec.partition_col) == F.lit(lo)) if lo else df
    names = [c for c in spec.columns if c in df.columns]
    sample = [r[0] for r in audit_ops.sample_rows(first, names, 3).select(_row_text(names)).collect()]
    out.append((table, "sample", "INFO", len(sample), "; ".join(sample) or None))
    return spark.createDataFrame(out, FINDINGS_SCHEMA)


def _key_sets(spec: registry.ReportSpec) -> list:
    full_key = registry.FULL_DUPLICATE_KEYS.get(spec.name)
    return [spec.duplicate_key] + ([full_key] if full_key else [])


LARGEST = 5


def audit(spark: SparkSession, table: str, df: DataFrame | None = None) -> DataFrame:
    """C-5: findings for one report table: schema, row count, date coverage,
    NULL dates, duplicate key groups (the five largest shown) and a 3-row sample.

    Two passes over the table: one aggregate for counts/dates/NULLs, one
    grouped count for duplicates (kept, spill-safe, for its count and its
    top five).  The sample is read from the earliest date's partition only,
    so it prunes to one slice instead of ordering the table.  Only one-row
    results and at most five groups reach the driver.
    """
    spec = registry.report(table)
    df = df if df is not None else spark.table(table)
    p = audit_ops.audit_profile(df, spec.partition_col).first()
    # Both keys in one scan; the duplicate groups are kept (spill-safe) for
    # their counts and the top five.
    dups = audit_ops.audit_duplicates_sets(df, _key_sets(spec)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {r["key_set"]: r["count"] for r in dups.groupBy("key_set").count().collect()}
        main = dups.where(F.col("key_set") == 0).select("cnt", _row_text([*spec.duplicate_key, "cnt"]).alias("text"))
        top = [r["text"] for r in audit_ops.top_duplicates(main, ["text"], LARGEST).collect()] if counts.get(0) else []
    finally:
        dups.unpersist()
    return _findings(spark, table, spec, df, p.asDict(), counts.get(0, 0), top, counts.get(1, 0))


# -- incremental audit: findings by slice ---------------------------------------

SLICE_FINDINGS = ("table_name string, slice date, fingerprint string, rows bigint, duplicates bigint, duplicates_full bigint, "
                  "largest array<struct<cnt: bigint, text: string>>, audited_at timestamp")


def slice_fingerprints(df: DataFrame, slice_col: str) -> DataFrame:
    """(slice, fingerprint) of a stored table, from the names and times of each slice's files: no data column is read."""
    files = df.select(F.col(slice_col).alias("slice"), F.xxhash64("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size").alias("h")).distinct()
    halves = F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned("h", 32))
    return files.groupBy("slice").agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[h.cast("string") for h in halves]).alias("fingerprint"))


def audit_slices(df: DataFrame, spec: registry.ReportSpec) -> DataFrame:
    """Rows, duplicate groups and the largest of them, per slice.

    Every duplicate key holds the date, so no group reaches over two slices
    and the slices' findings add up to the table's.
    """
    day = F.col(spec.partition_col)
    rows = df.groupBy(day.alias("slice")).agg(F.count(F.lit(1)).alias("rows"))
    dups = audit_ops.audit_duplicates_sets(df, _key_sets(spec)).select(day.alias("day"), "key_set", "cnt", _row_text([*spec.duplicate_key, "cnt"]).alias("text"))
    rank = F.row_number().over(Window.partitionBy("day", "key_set").orderBy(F.desc("cnt"), "text"))
    main = F.col("key_set") == 0
    per = dups.withColumn("rank", rank).groupBy("day").agg(
        F.count_if(main).alias("duplicates"), F.count_if(~main).alias("duplicates_full"),
        F.collect_list(F.when(main & (F.col("rank") <= LARGEST), F.struct("cnt", "text"))).alias("largest"))  # at most five a slice
    met = rows.join(per, rows["slice"].eqNullSafe(per["day"]), "left")
    none = F.array().cast("array<struct<cnt: bigint, text: string>>")
    return met.select("slice", "rows", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("duplicates", "duplicates_full")], F.coalesce("largest", none).alias("largest"))


def audit_incremental(spark: SparkSession, table: str, store: str, df: DataFrame | None = None) -> DataFrame:
    """C-5 from stored findings: only slices whose files changed since the last audit are read again.

    ``store`` is a catalog table of findings by slice, made on the first call
    and appended to by each; the last ones of a slice count.  The result is
    that of ``audit``.  The slices' keys (days or months) pass the driver, so
    that the others are pruned.
    """
    spec = registry.report(table)
    df = df if df is not None else spark.table(table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {store} ({SLICE_FINDINGS}) USING parquet")
    state = slice_fingerprints(df, spec.partition_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def latest():
            kept = spark.table(store).where(F.col("table_name") == table).groupBy("slice").agg(F.max_by(F.struct("fingerprint", "rows", "duplicates", "duplicates_full", "largest"), "audited_at").alias("f"))
            return kept.select(F.col("slice").alias("known"), "f.*")

        def known(found):
            return state["slice"].eqNullSafe(found["known"]) & (state["fingerprint"] == found["fingerprint"])

        before = latest()
        changed = [r["slice"] for r in state.join(before, known(before), "left_anti").select("slice").collect()]
        if changed:
            day = F.col(spec.partition_col)
            part = day.isin([c for c in changed if c is not None])
            found = audit_slices(df.where(part | day.isNull() if None in changed else part), spec)
            rows = found.join(state.select(F.col("slice").alias("of"), "fingerprint"), F.col("slice").eqNullSafe(F.col("of")))
            rows.select(F.lit(table).alias("table_name"), "slice", "fingerprint", "rows", "duplicates", "duplicates_full", "largest",
                        F.current_timestamp().alias("audited_at")).coalesce(1).write.insertInto(store)  # a row a slice
            spark.catalog.refreshTable(store)
        after = latest()
        current = state.join(after, known(after)).select("slice", "rows", "duplicates", "duplicates_full", "largest")
        p = current.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), F.coalesce(F.sum(F.when(F.col("slice").isNull(), F.col("rows"))), F.lit(0)).alias("null_dates"),
            F.min("slice").alias("min_date"), F.max("slice").alias("max_date"), F.count("slice").alias("unique_dates"),
            F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicates"), F.coalesce(F.sum("duplicates_full"), F.lit(0)).alias("full")).first().asDict()
        groups = current.select(F.explode("largest").alias("g")).select("g.*")
        top = [r["text"] for r in audit_ops.top_duplicates(groups, ["text"], LARGEST).collect()]
    finally:
        state.unpersist()
    return _findings(spark, table, spec, df, p, p["duplicates"], top, p["full"])


def audit_all(spark: SparkSession, tables_: list[str] | None = None, frames: dict | None = None) -> DataFrame:
    """C-6: audit every report table; a failing table is reported, the others
    still run.  Ends with the per-table row summary (A-7).  ``frames`` gives
    other tables of known reports by name: ``{name: (report, rows)}``."""
    names = tables_ or [registry.REPORTS[n].table for n in
                        ("inventory_daily", "geo_monthly", "audience_interest",
                         "audience_demographics", "fill_rate")]
    parts = []
    for t in names:
        try:
            report, df = (frames or {}).get(t, (t, None))
            parts.append(audit(spark, report, df).withColumn("table_name", F.lit(t)))
        except Exception as e:  # noqa: BLE001 - one table's failure must not stop the rest
            parts.append(spark.createDataFrame(
                [(t, "error", "ERROR", None, f"{type(e).__name__}: {e}")], FINDINGS_SCHEMA))
            traceback.print_exc()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # A-7 summary: the row count of every table that could be audited.
    summary = out.where(F.col("check") == "total_rows").withColumn("check", F.lit("summary"))
    return out.unionByName(summary)
