from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.functions import (
    best_effort_timestamp,
    count_if,
    count_if_value,
    datetime_text,
    flag_is_set,
    iso_record,
    message,
    now,
    since_days,
    start_of_day,
    text_is,
    unique,
    year_month,
)
from stockroom.operators import blank_missing_tare_type, lost_values, parse_items, parse_with_quarantine, typed_items
from stockroom.schemas import ITEM_COLUMNS, ITEM_TYPED
from stockroom.sinks.publish import as_messages

SIX = dt.datetime(2024, 4, 25, 6, 22, 32)
SPELLINGS = {
    "2024-04-25 06:22:32": SIX,
    "2024-04-25 06:22:32.0": SIX,
    "2024-04-25 06:22:32.987654321": SIX,
    "2024-04-25T06:22:32": SIX,
    "2024-04-25T06:22:32Z": SIX,
    "2024-04-25T06:22:32.5+03:00": SIX - dt.timedelta(hours=3),
    "2024-04-25 06:22:32 -0530": SIX + dt.timedelta(hours=5, minutes=30),
    "2024-04-25 06:22": SIX.replace(second=0),
    "2024-04-25": dt.datetime(2024, 4, 25),
    "25/04/2024 06:22:32": SIX,
    "25.04.2024 06:22": SIX.replace(second=0),
    "25-04-2024": dt.datetime(2024, 4, 25),
    "20240425062232": SIX,
    "20240425": dt.datetime(2024, 4, 25),
    "1714026152": SIX,
    "1714026152000": SIX,
    "1714026152999": SIX,
    "2024/04/25 06:22:32": SIX,
    "2024/04/25": dt.datetime(2024, 4, 25),
    "20240425T062232": SIX,
    "25 Apr 2024 06:22:32": SIX,
    "25 april 2024 06:22": SIX.replace(second=0),
    "5 MAY 2024": dt.datetime(2024, 5, 5),
    "31 Feb 2024": None,
    "25 Abc 2024": None,
    "999999999": dt.datetime(2001, 9, 9, 1, 46, 39),
    "2024-02-30 00:00:00": None,
    "2024-04-25 25:00:00": None,
    "32/04/2024": None,
    "99999999": None,
    "2024": None,
    "junk": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Moscow", "America/New_York"])
def test_best_effort_timestamp(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(text,) for text in SPELLINGS], "text STRING")
        found = rows.select("text", best_effort_timestamp("text").alias("time")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {row.text: row.time for row in found} == SPELLINGS


def test_calendar_functions_keep_null_and_day(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59, 59, 999999),), (None,)], "t TIMESTAMP_NTZ")
    days = rows.select(start_of_day("t").alias("d"), year_month("t").alias("m"))
    assert dict(days.dtypes) == {"d": "timestamp_ntz", "m": "int"}
    assert [tuple(r) for r in days.collect()] == [(dt.datetime(2024, 1, 31), 202401), (None, None)]


def test_since_days_includes_the_bound(spark):
    times = [dt.datetime(2024, 1, 23), dt.datetime(2024, 1, 22, 23, 59, 59), None]
    rows = spark.createDataFrame([(t,) for t in times], "t TIMESTAMP_NTZ")
    assert [r.t for r in rows.where(since_days("t", 7, dt.date(2024, 1, 30))).collect()] == times[:1]


def test_now_is_one_value(spark):
    rows = spark.range(1000).repartition(4).select(now().alias("t"))
    assert rows.distinct().count() == 1
    assert spark.range(1).select(now(SIX)).first()[0] == SIX


def test_conditional_counts_differ_on_null_values(spark):
    rows = spark.createDataFrame([(1, 5), (None, 5), (None, 1), (2, None)], "x BIGINT, y BIGINT")
    over = F.col("y") > 3
    found = rows.agg(count_if(over), count_if_value("x", over), unique("x"), F.count("*")).first()
    assert tuple(found) == (2, 1, 2, 4)


def test_conditions(spark):
    rows = spark.createDataFrame([("0", "1"), ("00", "x"), (None, None), ("", "0")], "a STRING, b STRING")
    found = rows.select(text_is("a", "0"), flag_is_set("b")).collect()
    assert [tuple(r) for r in found] == [(True, True), (False, None), (None, None), (False, False)]
    assert rows.select(F.lit(0).alias("n")).where(text_is("n", "0")).count() == 4
    assert rows.select(F.lit(True).alias("f")).where(text_is("f", "1")).count() == 4


def as_values(spark, *texts):
    return spark.createDataFrame([(bytearray(text.encode()),) for text in texts], "value BINARY")


def test_parse_edge_messages(spark):
    messages = as_values(
        spark,
        '{"shk_id": 7, "tare_type": NaN, "state_id": "WMI", "extra": 1}',
        "{bad",
        '{"shk_id": "07"}',
        '{"shk_id": 18023180111, "tare_type": "", "place_cod": null}',
        '{"state_id": "Ж\\u0416"}',
    )
    found = blank_missing_tare_type(parse_items(messages))
    assert found.columns == ITEM_COLUMNS
    rows = [tuple(r) for r in found.select("shk_id", "tare_type", "state_id", "place_cod").collect()]
    assert rows == [
        ("7", "", "WMI", None),
        (None, None, None, None),
        ("07", None, None, None),
        ("18023180111", "", None, None),
        (None, None, "ЖЖ", None),
    ]


def test_quarantine_keeps_the_text_of_broken_messages(spark):
    texts = ['{"shk_id": 7}', "{}", "{bad", "", '{"shk_id": 1', "[]", "5"]
    messages = as_values(spark, *texts).union(spark.sql("SELECT CAST(NULL AS BINARY)"))
    rows = parse_with_quarantine(messages).select("shk_id", "broken_message").collect()
    assert [tuple(r) for r in rows[:2]] == [("7", None), (None, None)]
    assert [r.broken_message for r in rows[2:]] == [*texts[2:], ""]


def test_typed_layer_and_losses(spark):
    raw = {name: None for name in ITEM_COLUMNS} | {
        "shk_id": "12x",
        "tare_id": "3541337019",
        "dt": "2024-04-25 06:22:32.0",
        "correction_dt": "never",
        "isstock": "1",
        "isdeleted": "0",
        "state_id": "WMI",
    }
    items = spark.createDataFrame([tuple(raw.values())], ", ".join(f"{c} STRING" for c in raw))
    assert [(f.name, f.dataType) for f in typed_items(items).schema] == [(f.name, f.dataType) for f in ITEM_TYPED]
    row = typed_items(items).first()
    assert (row.shk_id, row.tare_id, row.dt, row.correction_dt) == (None, 3541337019, SIX, None)
    assert (row.isstock, row.isdeleted, row.state_id) == (True, False, "WMI")
    losses = items.agg(*lost_values(items)).first().asDict()
    assert {name for name, lost in losses.items() if lost} == {"shk_id_lost", "correction_dt_lost"}


def test_messages_keep_nulls_and_microseconds(spark):
    time = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    rows = spark.createDataFrame([(1, time, None)], "a INT, t TIMESTAMP_NTZ, s STRING")
    text = as_messages(rows).select(F.col("value").cast("string")).first()[0]
    assert text == '{"a":1,"t":"2024-01-01 00:00:00.123456","s":null}'
    assert rows.select(message(["a"]).cast("string")).first()[0] == '{"a":1}'
    assert rows.select(datetime_text("t")).first()[0] == "2024-01-01 00:00:00.123456"
    assert rows.select(iso_record(["a", "t"])).first()[0] == '{"a":1,"t":"2024-01-01T00:00:00.123"}'


def test_nested_times_keep_their_digits(spark):
    time = dt.datetime(2024, 4, 25, 6, 22, 32, 123456)
    schema = "a STRUCT<t: TIMESTAMP_NTZ, n: INT>, b ARRAY<TIMESTAMP_NTZ>, c MAP<STRING, DATE>, d STRUCT<t: TIMESTAMP_NTZ>"
    rows = spark.createDataFrame([((time, 1), [time, None], {"k": time.date()}, None)], schema)
    text = as_messages(rows).select(F.col("value").cast("string")).first()[0]
    assert text == (
        '{"a":{"t":"2024-04-25 06:22:32.123456","n":1},"b":["2024-04-25 06:22:32.123456",null],'
        '"c":{"k":"2024-04-25"},"d":null}'
    )
