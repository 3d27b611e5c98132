from __future__ import annotations

import random

import pytest
from helpers import rows_of, with_lost_tasks
from pyspark.sql import functions as F

from stockroom.operators import daily_report, expand_records, office_totals, record_arrays
from stockroom.schemas import STAGING
from stockroom.sinks import append_rows, create_table, publish
from stockroom.sources import folder_topic, kafka_connection, kafka_topic
from stockroom.streaming import (
    Admission,
    DailyReportState,
    MergeableState,
    batch_table_columns,
    keep_daily_report,
    keep_office_totals,
    latest_totals,
    load_into,
    office_state,
    running_office_totals,
)
from stockroom.streaming.admission import UNTIL_DRAINED
from stockroom.streaming.loading import BATCH_COLUMNS, overwrite_batch


@pytest.fixture
def staged(spark):
    """A third of the rows in one office."""
    return spark.range(3000).select(
        F.col("id").alias("shk_id"),
        F.when(F.col("id") < 1000, 0).otherwise(F.pmod("id", F.lit(40))).cast("bigint").alias("office_id"),
        (F.pmod("id", F.lit(3)) == 0).alias("is_stock"),
        F.lit("2024-06-28 12:00:00").cast("timestamp_ntz").alias("dt_load"),
    )


def stream_of(spark, rows, path, files, per_batch=1):
    rows.repartitionByRange(files, "shk_id").write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


class Lost(Exception):
    pass


def test_replayed_batch_is_not_counted_twice(spark, database, staged, tmp_path, monkeypatch):
    create_table(spark, f"{database}.items", batch_table_columns(STAGING), partition_by=BATCH_COLUMNS)
    stream = stream_of(spark, staged, str(tmp_path / "in"), 4)
    attempts = []

    def fail_once_after_write(rows, table, run_id, batch_id):
        overwrite_batch(rows, table, run_id, batch_id)
        attempts.append(batch_id)
        if attempts == [0, 1]:
            raise Lost

    monkeypatch.setattr("stockroom.streaming.loading.overwrite_batch", fail_once_after_write)
    checkpoint = str(tmp_path / "cp")
    with pytest.raises(Exception, match="Lost"):
        load_into(stream, f"{database}.items", checkpoint, UNTIL_DRAINED).awaitTermination()
    load_into(stream, f"{database}.items", checkpoint, UNTIL_DRAINED).awaitTermination()
    assert attempts == [0, 1, 1, 2, 3]
    loaded = spark.table(f"{database}.items").drop(*BATCH_COLUMNS)
    assert loaded.count() == 3000 and loaded.exceptAll(staged).isEmpty()
    load_into(stream, f"{database}.items", checkpoint, UNTIL_DRAINED).awaitTermination()
    assert len(attempts) == 5


def test_lost_tasks_leave_whole_results(spark, database, staged, tmp_path):
    shaky = with_lost_tasks(staged.repartition(3))
    create_table(spark, f"{database}.items", batch_table_columns(STAGING), partition_by=BATCH_COLUMNS)
    overwrite_batch(shaky, f"{database}.items", "run", 0)
    assert rows_of(spark.table(f"{database}.items").drop(*BATCH_COLUMNS)) == rows_of(staged)
    create_table(spark, f"{database}.sorted", STAGING, sort_key=["office_id"])
    append_rows(spark, f"{database}.sorted", shaky, clustered=True)
    assert rows_of(spark.table(f"{database}.sorted")) == rows_of(staged)
    topic = folder_topic(str(tmp_path / "topic"))
    assert publish(shaky, topic) == 3000
    assert topic.read(spark).count() == 3000
    arrays = record_arrays(shaky, ["shk_id", "office_id"], max_records=100)
    records = expand_records(arrays, "shk_id bigint, office_id bigint")
    assert rows_of(records) == rows_of(staged.select("shk_id", "office_id"))


def test_running_stream_picks_up_later_messages(spark, database, staged, tmp_path):
    create_table(spark, f"{database}.items", batch_table_columns(STAGING), partition_by=BATCH_COLUMNS)
    path = str(tmp_path / "in")
    stream = stream_of(spark, staged.where("shk_id < 100"), path, 1)
    query = load_into(stream, f"{database}.items", str(tmp_path / "cp"))
    try:
        query.processAllAvailable()
        assert spark.table(f"{database}.items").count() == 100
        stream_of(spark, staged.where("shk_id >= 100"), path, 1)
        query.processAllAvailable()
        assert spark.table(f"{database}.items").count() == 3000
    finally:
        query.stop()


def test_new_checkpoint_does_not_overwrite_earlier_batches(spark, database, staged, tmp_path):
    create_table(spark, f"{database}.items", batch_table_columns(STAGING), partition_by=BATCH_COLUMNS)
    for name, part in (("a", staged.where("shk_id < 10")), ("b", staged.where("shk_id >= 10"))):
        stream = stream_of(spark, part, str(tmp_path / name), 1)
        load_into(stream, f"{database}.items", str(tmp_path / f"cp-{name}"), UNTIL_DRAINED).awaitTermination()
    assert spark.table(f"{database}.items").count() == 3000
    assert spark.table(f"{database}.items").select("run_id").distinct().count() == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_and_compaction_gives_the_batch_totals(spark, database, staged, seed):
    chance = random.Random(seed)
    state = office_state(f"{database}.office{seed}").create(spark)
    expected = rows_of(office_totals(staged))
    cuts = sorted(chance.sample(range(3000), 5))
    pieces = list(zip([0, *cuts], [*cuts, 3000], strict=True))
    chance.shuffle(pieces)
    for number, (low, high) in enumerate(pieces):
        part = staged.where((F.col("shk_id") >= low) & (F.col("shk_id") < high))
        state.add(office_totals(part), f"run{number % 2}", number)
        if chance.random() < 0.6:
            state.compact(spark, full=chance.random() < 0.3)
        if chance.random() < 0.5:
            state.discard_covered(spark)
    assert rows_of(state.current(spark)) == expected
    state.compact(spark)
    assert rows_of(state.current(spark)) == expected
    state.compact(spark, full=True)
    state.discard_covered(spark)
    assert spark.table(state.merged).select("set_id").distinct().count() == 1
    assert rows_of(state.current(spark)) == expected


def test_unpublished_compaction_is_not_read(spark, database, staged):
    state = office_state(f"{database}.office").create(spark)
    for number in range(3):
        state.add(office_totals(staged.where(F.pmod("shk_id", F.lit(3)) == number)), "run", number)
    expected = rows_of(office_totals(staged))
    # What a compaction leaves behind when it is lost before publishing.
    state._create_merged(spark)
    state.current(spark).withColumn("set_id", F.lit("lost")).write.insertInto(state.merged)
    assert rows_of(state.current(spark)) == expected
    assert state.compact(spark) == 2
    assert state.compact(spark) == 0
    # A covered batch that is written again stays covered.
    state.add(office_totals(staged.where(F.pmod("shk_id", F.lit(3)) == 1)), "run", 1)
    assert rows_of(state.current(spark)) == expected
    # The batches that are covered go, the rows that no view has shown stay: another compaction may be writing them.
    assert state.discard_covered(spark) == 2
    assert spark.table(state.merged).where("set_id = 'lost'").count() == 40
    assert rows_of(state.current(spark)) == expected


def test_a_second_compaction_does_not_undo_the_first(spark, database, staged, monkeypatch):
    state = office_state(f"{database}.office").create(spark)
    for number in range(3):
        state.add(office_totals(staged.where(F.pmod("shk_id", F.lit(3)) == number)), "run", number)
    other, combine = office_state(f"{database}.office"), MergeableState.combine

    def overtaken(self, rows):
        if self is state:
            monkeypatch.setattr(MergeableState, "combine", combine)
            other.compact(spark)
        return combine(self, rows)

    monkeypatch.setattr(MergeableState, "combine", overtaken)
    with pytest.raises(RuntimeError, match="another job"):
        state.compact(spark)
    assert rows_of(state.current(spark)) == rows_of(office_totals(staged))


def test_merged_sets_stay_few(spark, database):
    state = MergeableState(f"{database}.t", {"k": "BIGINT"}).create(spark)
    for number in range(24):
        state.add(spark.range(number * 10, number * 10 + 10).toDF("k"), "run", number)
        state.compact(spark)
    assert len(state._shown(spark).sets) <= 6
    assert rows_of(state.current(spark)) == [(i,) for i in range(240)]


def test_state_without_measures_is_a_set(spark, database):
    state = MergeableState(f"{database}.`table`", {"k": "STRING"}).create(spark)
    for number, keys in enumerate((["a", "b"], ["b", None], ["a"])):
        state.add(spark.createDataFrame([(k,) for k in keys], "k STRING"), "run", number)
        state.compact(spark)
    assert rows_of(state.current(spark)) == [(None,), ("a",), ("b",)]


def test_incremental_totals_stage_the_rows_too(spark, database, staged, tmp_path):
    state = office_state(f"{database}.office").create(spark)
    create_table(spark, f"{database}.staged", batch_table_columns(STAGING), partition_by=BATCH_COLUMNS)
    stream = stream_of(spark, staged, str(tmp_path / "in"), 3)
    query = keep_office_totals(stream, state, str(tmp_path / "cp"), UNTIL_DRAINED, f"{database}.staged")
    query.awaitTermination()
    assert rows_of(state.current(spark)) == rows_of(office_totals(staged))
    assert spark.table(f"{database}.staged").count() == 3000
    assert spark.table(state.parts).select("batch_id").distinct().count() == 3


def test_running_totals_continue_after_restart(spark, database, staged, tmp_path):
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for part in (staged.where("shk_id < 1200"), staged.where("shk_id >= 1200")):
        stream = stream_of(spark, part, path, 2)
        running_office_totals(stream, checkpoint, UNTIL_DRAINED).awaitTermination()
    assert rows_of(latest_totals(spark, checkpoint)) == rows_of(office_totals(staged))
    # Nothing new: nothing is added again.
    running_office_totals(stream_of(spark, staged.limit(0), path, 2), checkpoint, UNTIL_DRAINED).awaitTermination()
    assert rows_of(latest_totals(spark, checkpoint)) == rows_of(office_totals(staged))
    first = rows_of(latest_totals(spark, checkpoint, batch_id=0))
    assert 0 < sum(row[2] for row in first) < 3000
    # Starting over, from a corrected topic.
    stream = stream_of(spark, staged.withColumn("is_stock", F.lit(True)), str(tmp_path / "again"), 2)
    running_office_totals(stream, str(tmp_path / "cp2"), UNTIL_DRAINED).awaitTermination()
    assert [row[1] == row[2] for row in rows_of(latest_totals(spark, str(tmp_path / "cp2")))] == [True] * 40


def test_running_totals_after_lost_tasks(spark, staged, tmp_path):
    stream = stream_of(spark, staged, str(tmp_path / "in"), 2)
    running_office_totals(with_lost_tasks(stream), str(tmp_path / "cp"), UNTIL_DRAINED).awaitTermination()
    assert rows_of(latest_totals(spark, str(tmp_path / "cp"))) == rows_of(office_totals(staged))


DAY_ITEMS = [
    ("1", "2024-02-03 10:00:00.0", "0", "1", "WWE", "0"),
    ("1", "2024-02-03 11:00:00.0", "0", "0", "PEP", "5"),
    ("2", "2024-02-04 11:00:00.0", None, None, None, None),
    ("3", "no time", "7", "1", "PEP", "1"),
    ("3", "no time", "8", "1", "PEP", "1"),
    (None, "2024-02-05 00:00:00", None, "1", "WWE", "0"),
]


@pytest.mark.parametrize("ids", ["set", "bitmap", "sketch"])
def test_incremental_daily_report_with_repeated_ids(spark, database, ids):
    columns = "shk_id STRING, dt STRING, tare_id STRING, isstock STRING, state_id STRING, place_cod STRING"
    report = DailyReportState(f"{database}.daily", ids).create(spark)
    for number, row in enumerate(DAY_ITEMS):
        report.add(spark.createDataFrame([row, row], columns), "run", number)
        report.compact(spark)
    whole = spark.createDataFrame([row for row in DAY_ITEMS for _ in range(2)], columns)
    assert rows_of(report.current(spark)) == rows_of(daily_report(whole))
    report.discard_covered(spark)
    assert rows_of(report.current(spark)) == rows_of(daily_report(whole))


def test_daily_report_stream(spark, database, tmp_path):
    columns = "shk_id STRING, dt STRING, tare_id STRING, isstock STRING, state_id STRING, place_cod STRING"
    items = spark.createDataFrame(DAY_ITEMS, columns)
    report = DailyReportState(f"{database}.daily").create(spark)
    stream = stream_of(spark, items, str(tmp_path / "in"), 3)
    keep_daily_report(stream, report, str(tmp_path / "cp"), UNTIL_DRAINED).awaitTermination()
    assert rows_of(report.current(spark)) == rows_of(daily_report(items))


def test_kafka_topic_options():
    env = {
        "KAFKA_BOOTSTRAP_SERVERS": "broker:1", "KAFKA_USERNAME": "u", "KAFKA_PASSWORD": "p", "KAFKA_CLIENT_ID": "c",
    }
    topic = kafka_topic("items", kafka_connection(env), group_id="g", max_offsets_per_trigger=10)
    assert topic.format == "kafka"
    assert topic.read_options["subscribe"] == "items"
    assert topic.read_options["startingOffsets"] == "earliest"
    assert "failOnDataLoss" not in topic.read_options
    assert topic.read_options["kafka.group.id"] == "g"
    assert topic.read_options["kafka.client.id"] == "c"
    assert topic.stream_options == {"maxOffsetsPerTrigger": "10", "failOnDataLoss": "false"}
    assert topic.write_options["topic"] == "items" and topic.write_options["kafka.retries"] == "3"
    assert 'username="u" password="p";' in topic.write_options["kafka.sasl.jaas.config"]
    assert "kafka.sasl.jaas.config" not in kafka_connection({})
    assert kafka_connection({})["kafka.bootstrap.servers"] == "localhost:9092"


def test_broker_topic_needs_the_connector(spark):
    for use in (kafka_topic("items", {}).stream, kafka_topic("items", {}).read):
        with pytest.raises(Exception, match="(?i)kafka"):
            use(spark)


def test_admission_limits():
    kafka = Admission().apply(kafka_topic("items", {}))
    assert kafka.stream_options == {
        "minOffsetsPerTrigger": "10000", "maxTriggerDelay": "100s", "maxOffsetsPerTrigger": "1000000",
        "failOnDataLoss": "false",
    }
    assert Admission().trigger() == {"processingTime": "10 seconds"}
    assert Admission().apply(folder_topic("/x")).stream_options == {"maxBytesPerTrigger": "100000000"}
    assert Admission(max_files=3).apply(folder_topic("/x")).stream_options == {"maxFilesPerTrigger": "3"}


def test_publish_counts_messages(spark, staged, tmp_path):
    topic = folder_topic(str(tmp_path / "topic"))
    assert publish(staged, topic) == 3000
    assert publish(staged.limit(0), topic) == 0
    assert topic.read(spark).count() == 3000
