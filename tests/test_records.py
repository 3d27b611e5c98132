"""Delimited files with line breaks in fields, cut into many byte ranges."""

from __future__ import annotations

import random

import pytest
from helpers import rows_of

from stockroom.sources import scan_delimited
from stockroom.sources.records import scan_records

SCHEMA = "id BIGINT, said STRING, n BIGINT"


@pytest.fixture
def small_ranges(spark):
    """Ranges of about so many bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}

    def set_to(size):
        for name in names:
            spark.conf.set(name, size)

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


def written(path, rows, end="\n", mark="", last=True):
    lines = ["id;said;n"]
    for number, said, n in rows:
        field = "" if said is None else '"' + said.replace('"', '""') + '"'
        lines.append(f"{number};{field};{'' if n is None else n}")
    text = mark + end.join(lines) + (end if last else "")
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write(text)
    return str(path)


def made_rows(seed, count, longest=60):
    draw = random.Random(seed)
    pieces = ["a", "bc", "\n", "\r\n", '"', ";", "é", "\U0001f600", " ", '""', "\n\n", '"\n', "1;2"]
    return [
        (at, "".join(draw.choices(pieces, k=draw.randint(1, longest))), draw.choice([None, 5, -1])) for at in range(count)
    ]


@pytest.mark.parametrize(("size", "seed"), [(17, 1), (64, 2), (200, 3)])
def test_ranges_anywhere_give_the_same_records(spark, small_ranges, tmp_path, size, seed):
    rows = made_rows(seed, 20) + [(99, "long\n" * 100 + '";"' * 50, 1)] + made_rows(seed + 10, 5)
    # Line breaks within fields stay as they are, whatever ends the records.
    path = written(tmp_path / "one.csv", rows, end="\r\n" if seed == 2 else "\n")
    small_ranges(size)
    found = scan_delimited(spark, path, SCHEMA, multi_line=True)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str)
    assert spark.read.text(path).rdd.getNumPartitions() > 4


def test_equals_the_reader_of_whole_files(spark, small_ranges, tmp_path):
    for at in range(3):
        written(tmp_path / f"{at}.csv", made_rows(at, 10), last=at != 2)
    reader = spark.read.option("sep", ";").option("header", True).option("escape", '"').option("multiLine", True)
    expected = reader.schema(SCHEMA).csv(str(tmp_path)).collect()
    small_ranges(50)
    found = scan_delimited(spark, str(tmp_path), SCHEMA, multi_line=True, empty_as_text=False).collect()
    assert sorted(map(str, found)) == sorted(map(str, expected)) and len(found) == 30


def test_headers_marks_and_empty_files(spark, small_ranges, tmp_path):
    small_ranges(9)
    path = written(tmp_path / "mark.csv", [(1, "x\ny", 2)], mark="﻿", end="\r\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("ID;Said;n\n\n")
    assert rows_of(scan_delimited(spark, str(tmp_path), SCHEMA, multi_line=True)) == [(1, "x\ny", 2)]
    with pytest.raises(ValueError, match="does not begin with the columns"):
        scan_delimited(spark, path, "id BIGINT, n BIGINT, said STRING", multi_line=True)


def test_a_quote_that_is_never_closed(spark, small_ranges, tmp_path):
    small_ranges(16)
    path = tmp_path / "open.csv"
    path.write_text('id;said;n\n1;"a\nb";2\n2;"never closed;3\n4;x;5\n')
    with pytest.raises(ValueError, match="does not end"):
        scan_delimited(spark, str(path), SCHEMA, multi_line=True)


def test_broken_records(spark, small_ranges, tmp_path):
    small_ranges(8)
    path = tmp_path / "broken.csv"
    path.write_text('id;said;n\n1;"a\nb";2\n2;"too\nfew"\n3;x;y\n')
    kept = rows_of(scan_delimited(spark, str(path), SCHEMA, multi_line=True, keep_broken=True), "id", "broken_line")
    assert kept == [(1, None), (2, '2;"too\nfew"'), (3, "3;x;y")]
    with pytest.raises(Exception, match="MALFORMED"):
        scan_delimited(spark, str(path), SCHEMA, multi_line=True).select("said").collect()


def test_ranges_that_changed_are_noticed(spark, small_ranges, tmp_path):
    path = written(tmp_path / "one.csv", made_rows(3, 50))
    small_ranges(64)
    records = scan_records(spark, path, ["id", "said", "n"], ";")
    small_ranges(128)
    with pytest.raises(Exception, match="split otherwise"):
        records.select("record").unionByName(records).collect()
