"""Jobs that go on where their last run ended."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from stockroom.operators import guarded_upsert, typed_items
from stockroom.plans import jobs
from stockroom.schemas import ITEM_COLUMNS, REPORTS
from stockroom.sinks import append_rows, create_table, replace_partitions
from stockroom.sinks.partitions import partition_values
from stockroom.sources import folder_topic
from stockroom.streaming import Admission, accounts, create_accounts, keep_account
from stockroom.streaming.admission import UNTIL_DRAINED


@pytest.fixture
def reports(spark, database):
    name = f"{database}.reports"
    create_table(spark, name, REPORTS, sort_key=["dt"])
    jobs.create_state_counts_by_day(spark, f"{database}.target")

    def add(hour, **counts):
        time = dt.datetime(2024, 8, 6, hour)
        append_rows(spark, name, spark.createDataFrame([(k, v, time) for k, v in counts.items()], REPORTS))

    return name, f"{database}.target", add


def target_rows(spark, target):
    return [(row.state_id, row.qty, row.dt_load.hour) for row in spark.table(target).orderBy("state_id").collect()]


def test_only_new_reports_are_merged(spark, reports, tmp_path):
    name, target, add = reports
    checkpoint = str(tmp_path / "cp")
    add(8, PEP=3, WWE=1)
    first = jobs.import_new_reports(spark, name, target, checkpoint)
    assert (first.received, first.inserted) == (2, 2)
    assert jobs.import_new_reports(spark, name, target, checkpoint).received == 0
    add(9, PEP=4)
    add(7, WWE=9, BRA=2)
    second = jobs.import_new_reports(spark, name, target, checkpoint)
    assert (second.received, second.inserted, second.updated, second.stale) == (3, 1, 1, 1)
    assert target_rows(spark, target) == [("BRA", 2, 7), ("PEP", 4, 9), ("WWE", 1, 8)]


def test_a_lost_import_is_made_up_for(spark, reports, tmp_path, monkeypatch):
    name, target, add = reports
    add(8, PEP=3)

    def lost_after_the_merge(*args):
        guarded_upsert(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "guarded_upsert", lost_after_the_merge)
    with pytest.raises(Exception, match="lost"):
        jobs.import_new_reports(spark, name, target, str(tmp_path / "cp"))
    monkeypatch.undo()
    again = jobs.import_new_reports(spark, name, target, str(tmp_path / "cp"))
    assert (again.received, again.unchanged) == (1, 1)
    assert target_rows(spark, target) == [("PEP", 3, 8)]


ITEM = {name: "0" for name in ITEM_COLUMNS} | {"tare_type": "", "state_id": "PEP", "correction_dt": ""}


def items_of(spark, *rows):
    values = [tuple((ITEM | row)[name] for name in ITEM_COLUMNS) for row in rows]
    return spark.createDataFrame(values, ", ".join(f"{name} STRING" for name in ITEM_COLUMNS))


def test_a_report_is_made_once(spark, database, reports):
    name, _, _ = reports
    items_of(spark, {"shk_id": "1"}).write.saveAsTable(f"{database}.items")
    time = dt.datetime(2024, 8, 6, 10)
    assert jobs.report_state_counts(spark, f"{database}.items", name, time)
    assert not jobs.report_state_counts(spark, f"{database}.items", name, time)
    assert jobs.report_state_counts(spark, f"{database}.items", name, dt.datetime(2024, 8, 6, 11))
    assert jobs.report_state_counts(spark, f"{database}.items", name)
    assert spark.table(name).count() == 3


def test_only_new_batches_are_typed(spark, database, tmp_path):
    loaded, typed, checkpoint = jobs.raw_items(f"{database}.raw").create(spark), f"{database}.typed", str(tmp_path / "cp")
    jobs.create_typed_items(spark, typed, by_batch=True)
    day = "2024-02-03 10:00:00.0"
    first = items_of(spark, {"shk_id": "1", "dt": day}, {"shk_id": "x", "dt": day}, {"shk_id": "3", "dt": "never"})
    loaded.add(first, "one", 0)
    counts = jobs.type_new_items(spark, f"{database}.raw", typed, checkpoint)
    assert (counts["rows"], counts["shk_id_lost"], counts["dt_lost"], counts["place_cod_lost"]) == (3, 1, 1, 0)
    assert jobs.type_new_items(spark, f"{database}.raw", typed, checkpoint) == {"rows": 0}
    second = items_of(spark, {"shk_id": "4", "dt": "2024-02-04 10:00:00.0"}, {"shk_id": "5", "dt": day})
    loaded.add(second, "one", 1)
    loaded.add(second, "other", 1)
    assert jobs.type_new_items(spark, f"{database}.raw", typed, checkpoint)["rows"] == 4
    # A batch that is loaded again, as after a lost commit, replaces itself.
    loaded.add(second, "other", 1)
    assert jobs.type_new_items(spark, f"{database}.raw", typed, checkpoint)["rows"] == 2
    expected = typed_items(first.unionByName(second).unionByName(second))
    assert rows_of(spark.table(typed).select(*ITEM_COLUMNS)) == rows_of(expected)
    # What has been typed may go.
    loaded.compact(spark)
    loaded.discard_covered(spark)
    loaded.add(items_of(spark, {"shk_id": "6", "dt": day}), "other", 2)
    assert jobs.type_new_items(spark, f"{database}.raw", typed, checkpoint)["rows"] == 1
    report = jobs.quality_report(spark, typed, last_days=3, as_of=dt.date(2024, 2, 4)).collect()
    assert [row["qty_shk"] for row in sorted(report, key=lambda row: row["dt_day"])] == [3, 1]


def test_replaced_partitions_are_the_only_ones_made_known(spark, database, tmp_path):
    table = f"{database}.t"
    spark.sql(f"CREATE TABLE {table} (a INT, d DATE, k STRING) USING parquet PARTITIONED BY (d, k)")
    day = dt.date(2024, 1, 2)
    schema = "a INT, d DATE, k STRING"
    replace_partitions(spark.createDataFrame([(1, day, "it's = a/b\\c"), (2, None, None), (3, day, "")], schema), table)
    assert rows_of(spark.table(table), "a") == [(1,), (2,), (3,)]
    # A folder that another writer is about to make known is none of ours.
    place = tmp_path / database / "t" / "d=2024-05-05" / "k=new"
    spark.createDataFrame([(9,)], "a INT").write.parquet(str(place))
    replace_partitions(spark.createDataFrame([(4, day, "it's = a/b\\c"), (5, day, "z")], schema), table)
    assert rows_of(spark.table(table), "a") == [(2,), (3,), (4,), (5,)]
    assert len(partition_values(spark, table)) == 4
    replace_partitions(spark.createDataFrame([], schema), table)
    assert spark.table(table).where(F.col("d").isNull()).count() == 1


@pytest.mark.parametrize("with_quarantine", [True, False])
def test_accounts_of_a_load(spark, database, tmp_path, monkeypatch, with_quarantine):
    topic = folder_topic(str(tmp_path / "topic"))
    whole = [(f'{{"shk_id": {at}}}',) for at in range(5)]
    for messages in (whole, [("{bad",), ("",), *whole[:2]]):
        topic.append(spark.createDataFrame(messages, "value STRING").select(F.col("value").cast("binary")).coalesce(1))
    topic = Admission(max_files=1).apply(topic)
    jobs.create_raw_items(spark, f"{database}.raw")
    create_accounts(spark, f"{database}.accounts")
    quarantine = f"{database}.broken" if with_quarantine else None
    if quarantine:
        jobs.create_quarantine(spark, quarantine)
    places = f"{database}.raw", str(tmp_path / "cp"), UNTIL_DRAINED, quarantine

    def lost_after_the_account(*args):
        keep_account(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "keep_account", lost_after_the_account)
    with pytest.raises(Exception, match="lost"):
        jobs.load_items(spark, topic, *places, accounts=f"{database}.accounts").awaitTermination()
    monkeypatch.undo()
    for _ in range(2):
        jobs.load_items(spark, topic, *places, accounts=f"{database}.accounts").awaitTermination()
    found = accounts(spark, f"{database}.accounts")
    expected = [(0, 5, 5, 0, False), (1, 4, 2, 2, False)] if quarantine else [(0, 5, 5, 0, False), (1, 4, 4, 0, False)]
    assert rows_of(found, "batch_id", "rows_read", "loaded", "broken", "open") == expected
    assert spark.table(f"{database}.raw").count() == sum(row[2] for row in expected)
