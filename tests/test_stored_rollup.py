"""A series that is thinned step by step has what one rollup of all points gives."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import rows_of, with_lost_tasks
from pyspark.sql import functions as F

from stockroom.operators import RollupRule, StoredRollup, age_rollup
from stockroom.sinks.partitions import partition_values

RULES = (
    RollupRule("^click", "any", ((0, 3600), (86_400, 60))),
    RollupRule("", "max", ((0, 60), (3600, 300), (86_400, 3600), (3 * 86_400, 7200))),
)
FIRST_DAY = dt.datetime(2024, 1, 1)
SCHEMA = "id bigint, metric string, ts timestamp_ntz, value double"


def last_second(day):
    return FIRST_DAY + dt.timedelta(days=day + 1, seconds=-1)


def made_points(spark, day, count, seed):
    """Points of a day, of which a third belong to one metric and hour."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        second = draw.randrange(3600) if i % 3 == 0 else draw.randrange(86_400)
        metric = "views" if i % 3 == 0 else draw.choice(["click_cost", "views", "load", None])
        time = FIRST_DAY + dt.timedelta(days=day, seconds=second, microseconds=draw.randrange(10**6))
        value = None if i % 50 == 7 else round(draw.uniform(-5, 5), 3)
        rows.append((seed * 100_000 + i, metric, time, value))
    return spark.createDataFrame(rows, SCHEMA)


def in_one(points, as_of):
    return age_rollup(points, RULES, F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"))


@pytest.fixture
def series(spark, database):
    return StoredRollup(f"{database}.series", RULES).create(spark)


def test_daily_thinning_equals_one_rollup(spark, series):
    everything, reports = None, []
    for day in range(7):
        # Late points of two days ago come with today's.
        points = made_points(spark, day, 200, day + 1)
        if day >= 2:
            points = points.unionByName(made_points(spark, day - 2, 20, day + 50))
        everything = points if everything is None else everything.unionByName(points)
        series.add(points, last_second(day))
        reports.append(series.thin(spark, last_second(day)))
        assert rows_of(series.read(spark, last_second(day))) == rows_of(in_one(everything, last_second(day)))
    # A day is rewritten when its points are an hour, a day and three days old, and not again.
    assert {report.days for report in reports[4:]} == {3}
    assert sum(report.cells_kept for report in reports) < sum(report.cells_read for report in reports)
    assert len(partition_values(spark, series.table)) == 8  # With the day of metrics without a name.
    stored = spark.table(series.table).where("day = '2024-01-01' and metric = 'views'")
    assert stored.where("cell % 7200 <> 0").count() == 0 < stored.count() <= 12


def test_points_twice_and_lost_tasks_change_nothing(spark, series):
    points = made_points(spark, 0, 200, 1)
    series.add(with_lost_tasks(points), last_second(0))
    once = rows_of(spark.table(series.table))
    series.add(points, last_second(0))
    assert rows_of(spark.table(series.table)) == once
    series.thin(spark, last_second(2))
    thinned = rows_of(spark.table(series.table))
    assert series.thin(spark, last_second(2)).days == 0
    series.add(points, last_second(0))
    assert rows_of(spark.table(series.table)) == thinned
    assert rows_of(series.read(spark, last_second(2))) == rows_of(in_one(points, last_second(2)))


def test_a_lost_thinning_is_made_up_for(spark, series, monkeypatch):
    points = made_points(spark, 0, 200, 1)
    series.add(points, last_second(0))
    whole = StoredRollup._replace

    def lost_after_the_write(self, *args):
        whole(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(StoredRollup, "_replace", lost_after_the_write)
    with pytest.raises(RuntimeError, match="lost"):
        series.thin(spark, last_second(1))
    monkeypatch.undo()
    assert series.thin(spark, last_second(1)).days == 1
    assert rows_of(series.read(spark, last_second(1))) == rows_of(in_one(points, last_second(1)))


def test_times_that_share_a_cell_are_refused(spark, series):
    series.add(made_points(spark, 0, 10, 1), last_second(0))
    with pytest.raises(ValueError, match="last second"):
        series.read(spark, FIRST_DAY + dt.timedelta(hours=30))
    series.thin(spark, last_second(3))
    with pytest.raises(ValueError, match="later"):
        series.read(spark, last_second(1))
    with pytest.raises(ValueError, match="fill a day"):
        StoredRollup("t", (RollupRule("", "max", ((0, 7000),)),))


def test_an_empty_series(spark, series):
    series.add(made_points(spark, 0, 0, 1), last_second(0))
    assert series.thin(spark, last_second(0)).days == 0
    assert series.read(spark, last_second(0)).count() == 0
