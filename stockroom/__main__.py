"""Run a job from the command line: ``spark-submit ... -m stockroom`` or ``python -m stockroom <job> ...``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stockroom.operators.upsert import BATCH_KEY, rejected_columns
from stockroom.plans import jobs
from stockroom.schemas import REPORTS, STATE_COUNTS_BY_DAY
from stockroom.session import build_session
from stockroom.sinks import create_layers, create_table
from stockroom.sources import Topic, folder_topic, kafka_topic
from stockroom.streaming import Admission, DailyReportState, create_accounts, office_state
from stockroom.streaming.admission import EVERY_SECOND, UNTIL_DRAINED


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stockroom", description=__doc__)
    jobs_ = parser.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *required: str, topic: bool = False) -> argparse.ArgumentParser:
        command = jobs_.add_parser(name, help=about)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        if topic:
            place = command.add_mutually_exclusive_group(required=True)
            place.add_argument("--topic", help="topic of the broker named in KAFKA_BOOTSTRAP_SERVERS")
            place.add_argument("--topic-folder", help="folder of messages instead of a broker")
            command.add_argument("--group-id")
        return command

    job("create-layers", "create the layer databases").add_argument("--location")
    job("publish-file", "publish a delimited item file", "path", topic=True).add_argument("--sep", default=";")
    job("publish-table", "publish columns of a table", "table", "columns", topic=True)
    job("read-topic", "decode all messages of a topic", "schema", "out", topic=True)
    load = job("load-items", "stream item messages into a table", "table", "checkpoint", topic=True)
    ingest = job("ingest-stock", "buffered ingest with totals", "staging", "state", "checkpoint", topic=True)
    keep = job("keep-report", "stream items into the daily report's state", "state", "checkpoint", topic=True)
    show = job("kept-report", "the daily report from its state", "state", "out")
    for command in (keep, show):
        command.add_argument("--ids", choices=["sketch", "bitmap", "set"], default="sketch", help="how ids are kept")
    usual = Admission()
    for command in (load, ingest, keep):
        command.add_argument("--until-drained", action="store_true", help="stop when all present messages are loaded")
        command.add_argument("--max-rows", type=int, default=usual.max_rows, help="messages per batch, of a broker")
        command.add_argument("--max-bytes", type=int, default=usual.max_bytes, help="bytes per batch, of a folder")
        command.add_argument("--max-files", type=int, help="files per batch, of a folder, instead of bytes")
        command.add_argument("--compact-every", type=int, default=100, help="batches between compactions, 0 for none")
    for command in (load, ingest):
        command.add_argument("--quarantine", help="table for broken messages")
        command.add_argument("--accounts", help="table for what became of every batch")
    ingest.add_argument("--min-rows", type=int, default=usual.min_rows, help="messages a batch waits for")
    ingest.add_argument("--max-seconds", type=int, default=usual.max_seconds, help="how long it waits at most")
    ingest.add_argument("--every-seconds", type=int, default=usual.every_seconds, help="how often it looks")
    for compact in (
        job("compact-stock", "combine the stored totals' batches", "state"),
        job("compact-items", "gather the loaded items' batches", "table"),
        job("compact-staging", "gather the staged rows' batches", "table"),
    ):
        compact.add_argument("--full", action="store_true", help="also combine the results of earlier compactions")
        compact.add_argument("--discard", action="store_true", help="also delete what was combined")
    job("stock-totals", "totals per office", "state", "out")
    typed = job("type-items", "raw items as typed ones, by day", "items", "typed")
    typed.add_argument("--checkpoint", help="type only batches that no earlier run with it has typed")
    job("export-reports", "the reports as record arrays", "reports", "out")
    records = job("import-records", "merge record arrays into the counts by day", "records", "target")
    records.add_argument("--rejected", help="table for rows without a key")
    for name, about in (
        ("report-states", "count items by state into the reports"),
        ("state-report", "count by state, then merge the reports"),
    ):
        command = job(name, about, "items", "reports")
        command.add_argument("--as-of", type=dt.datetime.fromisoformat)
        if name == "state-report":
            command.add_argument("--target", required=True)
    merge = job("import-reports", "merge the reports into the counts by day", "reports", "target")
    merge.add_argument("--checkpoint", help="merge only reports that no earlier run with it has merged")
    report = job("quality-report", "the daily quality report", "items", "out")
    report.add_argument("--approximate", action="store_true", help="estimate the numbers of different ids")
    for command in (report, typed):
        command.add_argument("--last-days", type=int)
        command.add_argument("--as-of", type=dt.date.fromisoformat)
    return parser


def _topic(options: argparse.Namespace) -> Topic:
    if options.topic_folder:
        return folder_topic(options.topic_folder)
    return kafka_topic(options.topic, group_id=options.group_id)


def _admission(options: argparse.Namespace) -> Admission:
    own = {name: getattr(options, name) for name in ("max_rows", "max_bytes", "max_files")}
    more = {name: getattr(options, name) for name in ("min_rows", "max_seconds", "every_seconds") if name in options}
    return Admission(**own, **more)


def _deliver(rows: DataFrame, out: str) -> None:
    """Write the whole result as a Parquet folder."""
    rows.write.mode("overwrite").parquet(out)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    match options.job:
        case "create-layers":
            create_layers(spark, options.location)
        case "publish-file":
            print(jobs.publish_file(spark, options.path, _topic(options), options.sep), "messages")
        case "publish-table":
            print(jobs.publish_table(spark, options.table, options.columns.split(","), _topic(options)), "messages")
        case "read-topic":
            _deliver(jobs.read_topic(spark, _topic(options), options.schema), options.out)
        case "load-items":
            jobs.create_raw_items(spark, options.table)
            if options.quarantine:
                jobs.create_quarantine(spark, options.quarantine)
            if options.accounts:
                create_accounts(spark, options.accounts)
            trigger = UNTIL_DRAINED if options.until_drained else EVERY_SECOND
            topic = _admission(options).limit(_topic(options))
            jobs.load_items(
                spark,
                topic,
                options.table,
                options.checkpoint,
                trigger,
                options.quarantine,
                options.compact_every or None,
                options.accounts,
            ).awaitTermination()
        case "keep-report":
            report = DailyReportState(options.state, options.ids).create(spark)
            trigger = UNTIL_DRAINED if options.until_drained else EVERY_SECOND
            topic = _admission(options).limit(_topic(options))
            jobs.keep_report(
                spark, topic, report, options.checkpoint, trigger, options.compact_every or None
            ).awaitTermination()
        case "kept-report":
            _deliver(DailyReportState(options.state, options.ids).current(spark), options.out)
        case "ingest-stock":
            jobs.staged_rows(options.staging).create(spark)
            state = office_state(options.state).create(spark)
            if options.accounts:
                create_accounts(spark, options.accounts)
            trigger = UNTIL_DRAINED if options.until_drained else None
            jobs.ingest_stock(
                spark,
                _topic(options),
                options.staging,
                state,
                options.checkpoint,
                _admission(options),
                trigger,
                options.quarantine,
                options.compact_every or None,
                options.accounts,
            ).awaitTermination()
        case "compact-stock" | "compact-items" | "compact-staging":
            if options.job == "compact-stock":
                stored = office_state(options.state)
            else:
                stored = (jobs.raw_items if options.job == "compact-items" else jobs.staged_rows)(options.table)
            print(stored.compact(spark, options.full), "batches combined")
            if options.discard:
                stored.discard_covered(spark)
        case "stock-totals":
            _deliver(office_state(options.state).current(spark), options.out)
        case "report-states" | "state-report":
            create_table(spark, options.reports, REPORTS, sort_key=["dt"], if_not_exists=True)
            jobs.report_state_counts(spark, options.items, options.reports, options.as_of)
            if options.job == "state-report":
                jobs.create_state_counts_by_day(spark, options.target)
                print(jobs.import_reports(spark, options.reports, options.target))
        case "import-reports" if options.checkpoint:
            jobs.create_state_counts_by_day(spark, options.target)
            print(jobs.import_new_reports(spark, options.reports, options.target, options.checkpoint))
        case "import-reports":
            jobs.create_state_counts_by_day(spark, options.target)
            print(jobs.import_reports(spark, options.reports, options.target))
        case "export-reports":
            _deliver(jobs.export_reports(spark, options.reports), options.out)
        case "import-records":
            jobs.create_state_counts_by_day(spark, options.target)
            if options.rejected:
                columns = rejected_columns(STATE_COUNTS_BY_DAY)
                create_table(spark, options.rejected, columns, partition_by=[BATCH_KEY], if_not_exists=True)
            records = spark.read.parquet(options.records)
            print(jobs.import_records(spark, records, options.target, options.rejected))
        case "type-items" if options.checkpoint:
            jobs.create_typed_items(spark, options.typed, by_batch=True)
            print(jobs.type_new_items(spark, options.items, options.typed, options.checkpoint))
        case "type-items":
            jobs.create_typed_items(spark, options.typed)
            print(jobs.type_items(spark, options.items, options.typed, options.last_days, options.as_of))
        case "quality-report":
            report = jobs.quality_report(spark, options.items, options.last_days, options.as_of, options.approximate)
            _deliver(report, options.out)


def main(argv: Sequence[str] | None = None) -> None:
    options = arguments().parse_args(argv)
    run(build_session(f"stockroom {options.job}"), options)


if __name__ == "__main__":
    main()
