"""Records of any fields."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from stockroom.operators import loose_records, observed_fields, typed_records
from stockroom.operators.variants import field, fields_of

TEXTS = [
    (1, '[{"a":1,"b":"x","c":{"d":[1,2.5]}},{"a":"no","e f":12345678901234567890123456789012345.678}]'),
    (2, '{"a":null,"t":"2024-01-01 10:00:00.123456"}'),
    (3, "{broken"),
    (4, None),
    (5, "[]"),
    (6, "7"),
    (7, '{"a":3,"A":4,"it\'s \\"\\\\":5}'),
    (8, ""),
]


def records(spark):
    return loose_records(spark.createDataFrame(TEXTS, "id int, text string"), "text", ["id"])


def test_arrays_and_single_records(spark):
    rows = records(spark).select("id", "at", "broken", F.col("record").isNull().alias("none")).collect()
    assert sorted((r["id"], r["at"], r["none"]) for r in rows) == [
        (1, 0, False), (1, 1, False), (2, 0, False), (3, 0, True), (4, 0, True), (6, 0, False), (7, 0, False),
        (8, 0, True),
    ]
    assert {r["id"]: r["broken"] for r in rows if r["broken"] is not None} == {3: "{broken", 8: ""}


def test_typed_fields_unknown_ones_and_lost_values(spark):
    typed = typed_records(records(spark), "a bigint, t timestamp_ntz", ["id"])
    assert typed.columns == ["id", "a", "t", "unknown", "lost"]
    found = {}
    for row in typed.collect():
        found.setdefault(row["id"], []).append((row["a"], row["t"], row["unknown"], row["lost"]))
    digits = "12345678901234567890123456789012345.678"
    assert sorted(found[1], key=str) == [
        (1, None, {"b": '"x"', "c": '{"d":[1,2.5]}'}, []),
        (None, None, {"e f": digits}, ["a"]),
    ]
    assert found[2] == [(None, dt.datetime(2024, 1, 1, 10, 0, 0, 123456), {}, [])]
    assert found[6] == found[3] == found[4] == [(None, None, None, [])]
    assert found[7] == [(3, None, {"A": "4", 'it\'s "\\': "5"}, [])]


def test_fields_of_any_name_and_type(spark):
    fields = fields_of("record")
    rows = records(spark).select(
        "id", field(fields, 'it\'s "\\', "int").alias("odd"), field(fields, "e f", "decimal(38,3)").alias("long")
    )
    assert {r["id"]: r["odd"] for r in rows.collect() if r["odd"] is not None} == {7: 5}
    assert [r["long"] for r in rows.collect() if r["long"] is not None] == [
        Decimal("12345678901234567890123456789012345.678")
    ]


def test_observed_fields(spark):
    found = {(r["name"], r["type"]): r["records"] for r in observed_fields(records(spark)).collect()}
    assert found[("a", "BIGINT")] == 2 and found[("a", "STRING")] == found[("a", "VOID")] == 1
    assert found[("e f", "DECIMAL(38,3)")] == 1


def test_no_records(spark):
    none = loose_records(spark.createDataFrame([], "text string"), "text")
    assert typed_records(none, "a int").count() == observed_fields(none).count() == 0
