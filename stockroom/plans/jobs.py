"""The jobs a user runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stockroom.functions import since_days
from stockroom.operators import (
    UpsertReport,
    blank_missing_tare_type,
    daily_report,
    expand_records,
    guarded_upsert,
    lost_values,
    parse_items,
    parse_with_quarantine,
    record_arrays,
    state_counts,
    typed_items,
)
from stockroom.operators.items import BROKEN_MESSAGE
from stockroom.schemas import (
    ITEM_COLUMNS,
    ITEM_DELIMITED,
    ITEM_TYPED,
    STAGING,
    STAGING_COLUMNS,
    STATE_COUNTS_BY_DAY,
)
from stockroom.sinks import append_rows, create_table, publish, replace_partitions
from stockroom.sources import Topic, read_back, scan_delimited, scan_table
from stockroom.streaming import (
    Admission,
    BatchedRows,
    DailyReportState,
    MergeableState,
    add_office_totals,
    batch_table_columns,
    compact_now_and_then,
    counted,
    for_each_batch,
    keep_account,
    keep_daily_report,
)
from stockroom.streaming.admission import EVERY_SECOND, UNTIL_DRAINED
from stockroom.streaming.loading import BATCH_COLUMNS, overwrite_batch

# The partition column of typed items.
DAY_PARTITION = "dt_date"

# Fixed value: the fields of a record set of state counts.
COUNT_RECORD = "dt_date date, state_id string, qty bigint, dt_load timestamp_ntz"


def publish_file(spark: SparkSession, path: str, topic: Topic, sep: str = ";") -> int:
    """Publish a delimited item file, one message per row."""
    return publish(scan_delimited(spark, path, ITEM_DELIMITED, sep), topic)


def publish_table(spark: SparkSession, table: str, columns: list[str], topic: Topic) -> int:
    """Publish the given columns of a table, one message per row."""
    return publish(scan_table(spark, table, columns), topic)


def load_items(
    spark: SparkSession,
    topic: Topic,
    table: str,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_SECOND,
    quarantine: str | None = None,
    compact_every: int | None = None,
    accounts: str | None = None,
) -> StreamingQuery:
    """Stream item messages into a table of raw items, parsed and cleaned on the executors.

    A broken message becomes a row of NULLs; with a ``quarantine`` table (see :func:`create_quarantine`) its text goes
    there instead. With ``accounts`` (see :func:`stockroom.streaming.create_accounts`) that table gets a row for every batch:
    what it brought, what was loaded, and what is broken. With ``compact_every`` the table is compacted after every so many
    batches.
    """
    target = raw_items(table)
    after_batch = compact_now_and_then(target, every=compact_every)

    def handle(rows: DataFrame, run_id: str, batch_id: int) -> None:
        rows = blank_missing_tare_type(rows)
        if quarantine is None:
            rows, seen = counted(rows)
            overwrite_batch(rows, target.parts, run_id, batch_id)
            counts = (seen.get["rows"], seen.get["rows"], 0)
        else:
            counts = _with_quarantine(
                rows, lambda whole: overwrite_batch(whole, target.parts, run_id, batch_id), quarantine, run_id, batch_id
            )
        if accounts:
            keep_account(rows.sparkSession, accounts, run_id, batch_id, *counts)
        after_batch(rows.sparkSession, batch_id)

    parse = parse_items if quarantine is None else parse_with_quarantine
    return for_each_batch(parse(topic.stream(spark)), handle, checkpoint, trigger)


def _with_quarantine(
    rows: DataFrame, store: Callable[[DataFrame], None], quarantine: str, run_id: str, batch_id: int
) -> tuple[int, int, int]:
    """Keep the text of broken messages in the quarantine, and hand the other rows on. Returns how many rows there were, how
    many were handed on and stored, and how many are broken."""
    # Kept, so that the batch is fetched and parsed once for both tables.
    rows = rows.persist()
    try:
        is_broken = F.col(BROKEN_MESSAGE).isNotNull()
        broken, seen_broken = counted(rows.where(is_broken))
        overwrite_batch(broken, quarantine, run_id, batch_id)
        whole, seen_whole = counted(rows.where(~is_broken).drop(BROKEN_MESSAGE))
        store(whole)
        return rows.count(), seen_whole.get["rows"], seen_broken.get["rows"]
    finally:
        rows.unpersist()


def raw_items(table: str) -> BatchedRows:
    """The table :func:`load_items` loads into: its batches and what they are compacted to."""
    return BatchedRows(table, dict.fromkeys(ITEM_COLUMNS, "STRING"), sort_key=("shk_id",))


def staged_rows(table: str) -> BatchedRows:
    """The staging table :func:`ingest_stock` loads into: its batches and what they are compacted to."""
    return BatchedRows(table, STAGING_COLUMNS, sort_key=("shk_id",))


def create_raw_items(spark: SparkSession, table: str) -> None:
    """The table of raw items, if it is missing."""
    raw_items(table).create(spark)


def create_typed_items(spark: SparkSession, table: str, by_batch: bool = False) -> None:
    """The table of typed items, partitioned by day, if it is missing; for :func:`type_new_items` also by loaded batch."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ITEM_TYPED.fields)
    columns, partitions = f"{columns}, {DAY_PARTITION} DATE", [DAY_PARTITION]
    if by_batch:
        columns, partitions = batch_table_columns(columns), [*partitions, *BATCH_COLUMNS]
    create_table(spark, table, columns, partition_by=partitions, if_not_exists=True)


def type_items(
    spark: SparkSession, items_table: str, typed_table: str, last_days: int | None = None, as_of: dt.date | None = None
) -> dict[str, int]:
    """Turn raw items into typed ones, and return how many values of each column do not convert.

    The days that the items have are replaced, so doing it again changes nothing; ``last_days`` leaves older days as
    they are. Items without a readable time are kept in a partition of their own, which ``last_days`` leaves out.
    """
    raw = scan_table(spark, items_table, ITEM_COLUMNS)
    typed = typed_items(raw).withColumn(DAY_PARTITION, F.col("dt").cast("date"))
    if last_days is not None:
        typed = typed.where(since_days("dt", last_days, as_of))
    replace_partitions(typed.hint("rebalance", DAY_PARTITION), typed_table)
    return raw.agg(*lost_values(raw)).first().asDict()


def type_new_items(spark: SparkSession, items_table: str, typed_table: str, checkpoint: str) -> dict[str, int]:
    """Turn the raw items loaded since the last run into typed ones; return how many there were (``rows``), and how many
    values of each column do not convert.

    A stream over the loaded batches tells which are new; each of them is read whole and replaces what the typed table, made
    with :func:`create_typed_items` by batch, has of it. So a batch that is loaded or typed again changes nothing, and older
    batches are not read. Loaded batches may be discarded once they have been typed.
    """
    parts = raw_items(items_table).parts
    counts: dict[str, int] = {"rows": 0}

    def handle(rows: DataFrame, run_id: str, batch_id: int) -> None:
        session = rows.sparkSession
        loaded: dict[str, list[int]] = {}
        for row in rows.distinct().collect():
            loaded.setdefault(row["run_id"], []).append(row["batch_id"])
        session.catalog.refreshTable(parts)
        fresh = F.lit(False)
        for run, batches in loaded.items():
            fresh |= (F.col("run_id") == run) & F.col("batch_id").isin(batches)
        raw = session.table(parts).where(fresh)
        lost = Observation()
        raw = raw.observe(lost, F.count("*").alias("rows"), *lost_values(raw))
        typed = typed_items(raw, BATCH_COLUMNS).withColumn(DAY_PARTITION, F.col("dt").cast("date"))
        replace_partitions(typed.hint("rebalance", DAY_PARTITION), typed_table)
        for name, count in lost.get.items():
            counts[name] = counts.get(name, 0) + count

    stream = spark.readStream.table(parts).select(*BATCH_COLUMNS)
    for_each_batch(stream, handle, checkpoint, UNTIL_DRAINED).awaitTermination()
    return counts


def create_quarantine(spark: SparkSession, table: str) -> None:
    """A table for the text of broken messages, if it is missing."""
    columns = batch_table_columns(f"{BROKEN_MESSAGE} STRING")
    create_table(spark, table, columns, partition_by=BATCH_COLUMNS, if_not_exists=True)


def ingest_stock(
    spark: SparkSession,
    topic: Topic,
    staging_table: str,
    state: MergeableState,
    checkpoint: str,
    admission: Admission = Admission(),
    trigger: Mapping[str, object] | None = None,
    quarantine: str | None = None,
    compact_every: int | None = None,
    accounts: str | None = None,
) -> StreamingQuery:
    """Buffered ingest of staging rows, which also keeps the totals per office current.

    A message that is no staging row, or has a value of another type, is no stock: its text goes to the quarantine table,
    which is ``<staging_table>_broken`` unless named, and nothing of it is counted. ``accounts`` are kept as by
    :func:`load_items`.
    """
    staged = staged_rows(staging_table)
    quarantine = quarantine or staged.beside("_broken")
    create_quarantine(spark, quarantine)
    after_batch = compact_now_and_then(staged, state, every=compact_every)

    def handle(rows: DataFrame, run_id: str, batch_id: int) -> None:
        counts = _with_quarantine(
            rows,
            lambda whole: add_office_totals(whole, state, run_id, batch_id, staged.parts),
            quarantine,
            run_id,
            batch_id,
        )
        if accounts:
            keep_account(rows.sparkSession, accounts, run_id, batch_id, *counts)
        after_batch(rows.sparkSession, batch_id)

    messages = admission.apply(topic).stream(spark)
    rows = parse_with_quarantine(messages.select("value"), T.StructType.fromDDL(STAGING))
    return for_each_batch(rows, handle, checkpoint, trigger or admission.trigger())


def report_state_counts(
    spark: SparkSession, items_table: str, reports_table: str, as_of: dt.datetime | None = None
) -> bool:
    """Count the items of every state and append the counts, with one load time, to the reports.

    A report that is there already, with the load time ``as_of``, is not made again; returns whether one was made.
    """
    if as_of is not None and not spark.table(reports_table).where(F.col("dt") == F.lit(as_of)).isEmpty():
        return False
    items = scan_table(spark, items_table, ITEM_COLUMNS)
    append_rows(spark, reports_table, state_counts(items, as_of, stamped=True, ordered=False))
    return True


def import_reports(spark: SparkSession, reports_table: str, target: str) -> UpsertReport:
    """Merge all reports into the table of state counts by day; sending a report again changes nothing."""
    reports = scan_table(spark, reports_table, ["state_id", "qty", "dt"])
    return guarded_upsert(spark, _by_day(reports), target)


def import_new_reports(spark: SparkSession, reports_table: str, target: str, checkpoint: str) -> UpsertReport:
    """Merge the reports written since the last run. The checkpoint keeps which files of the table have been merged, so no
    earlier report is read again; one whose merge was lost on the way is merged again, which changes nothing."""
    merged: list[UpsertReport] = []

    def handle(rows: DataFrame, run_id: str, batch_id: int) -> None:
        merged.append(guarded_upsert(rows.sparkSession, _by_day(rows), target))

    reports = spark.readStream.table(reports_table).select("state_id", "qty", "dt")
    for_each_batch(reports, handle, checkpoint, UNTIL_DRAINED).awaitTermination()
    return UpsertReport.total(merged)


def export_reports(spark: SparkSession, reports_table: str, max_records: int = 1000) -> DataFrame:
    """The reports as JSON record arrays that :func:`import_records` takes."""
    reports = _by_day(scan_table(spark, reports_table, ["state_id", "qty", "dt"]))
    return record_arrays(reports, reports.columns, max_records)


def import_records(
    spark: SparkSession, records: DataFrame, target: str, rejected: str | None = None
) -> UpsertReport:
    """Merge JSON record arrays into the table of state counts by day. A value that does not convert fails the job."""
    return guarded_upsert(spark, expand_records(records, COUNT_RECORD, strict=True), target, rejected=rejected)


def _by_day(reports: DataFrame) -> DataFrame:
    return reports.select(
        F.col("dt").cast("date").alias("dt_date"), "state_id", "qty", F.col("dt").alias("dt_load")
    )


def create_state_counts_by_day(spark: SparkSession, table: str) -> None:
    """The upsert target, if it is missing."""
    create_table(spark, table, STATE_COUNTS_BY_DAY, partition_by=["dt_date"], if_not_exists=True)


def quality_report(
    spark: SparkSession,
    items_table: str,
    last_days: int | None = None,
    as_of: dt.date | None = None,
    approximate: bool = False,
) -> DataFrame:
    """The daily quality report of a table, for all days or the last ones.

    Of a table made by :func:`type_items` the last days are read alone; raw items have to be read whole.
    """
    items = spark.table(items_table)
    if last_days is not None and DAY_PARTITION in items.columns:
        items = items.where(since_days(DAY_PARTITION, last_days, as_of))
    return daily_report(items.select(*ITEM_COLUMNS), approximate, last_days, as_of)


def keep_report(
    spark: SparkSession,
    topic: Topic,
    report: DailyReportState,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_SECOND,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Stream item messages into the state of the daily quality report."""
    items = blank_missing_tare_type(parse_items(topic.stream(spark)))
    return keep_daily_report(items, report, checkpoint, trigger, compact_every)


def read_topic(spark: SparkSession, topic: Topic, schema: T.StructType | str) -> DataFrame:
    """All messages of a topic from its earliest offset, decoded; nothing is committed, so every run reads all."""
    return read_back(topic.read(spark), schema)
