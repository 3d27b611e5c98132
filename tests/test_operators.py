from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from stockroom.operators import (
    RollupRule,
    age_rollup,
    bitmap_state,
    bitmap_totals,
    daily_report,
    expand_records,
    guarded_merge,
    guarded_upsert,
    record_arrays,
    sketch_state,
    sketch_totals,
    state_counts,
)
from stockroom.operators.upsert import BATCH_KEY, rejected_columns
from stockroom.sinks import create_table

DAY, NEXT = dt.date(2024, 8, 6), dt.date(2024, 8, 7)


def at(number):
    return None if number is None else dt.datetime(2024, 8, 6) + dt.timedelta(minutes=number)


def counts(spark, *rows):
    return spark.createDataFrame(
        [(day, state, qty, at(load)) for day, state, qty, load in rows],
        "dt_date DATE, state_id STRING, qty INT, dt_load TIMESTAMP_NTZ",
    )


# Existing, incoming and resulting (day, state, quantity, load minute).
CASES = {
    "tie": ((DAY, "A", 1, 10), (DAY, "A", 91, 10), (DAY, "A", 91, 10)),
    "newer": ((DAY, "E", 1, 10), (DAY, "E", 92, 11), (DAY, "E", 92, 11)),
    "stale": ((DAY, "C", 3, 20), (DAY, "C", 93, 5), (DAY, "C", 3, 20)),
    "untouched": ((DAY, "B", 2, 10), None, (DAY, "B", 2, 10)),
    "new": (None, (NEXT, "A", 97, 11), (NEXT, "A", 97, 11)),
    "new without time": (None, (NEXT, "Q", 98, None), (NEXT, "Q", 98, None)),
    "existing time unknown": ((DAY, "N", 4, None), (DAY, "N", 94, 50), (DAY, "N", 4, None)),
    "incoming time unknown": ((DAY, "M", 5, 5), (DAY, "M", 95, None), (DAY, "M", 5, 5)),
    "both unknown": ((DAY, "Z", 6, None), (DAY, "Z", 96, None), (DAY, "Z", 6, None)),
    "quantity unknown": ((DAY, "U", 6, 1), (DAY, "U", None, 2), (DAY, "U", None, 2)),
}


def of_cases(spark, position):
    return counts(spark, *[case[position] for case in CASES.values() if case[position]])


def test_merge_rules(spark):
    merged = guarded_merge(of_cases(spark, 0), of_cases(spark, 1), ["dt_date", "state_id"], "dt_load")
    assert rows_of(merged) == rows_of(of_cases(spark, 2))


@pytest.fixture
def target(spark, database):
    name = f"{database}.counts"
    columns = "state_id CHAR(3), qty INT, dt_load TIMESTAMP_NTZ, dt_date DATE"
    create_table(spark, name, columns, partition_by=["dt_date"])
    return name


def stored(spark, target):
    rows = spark.table(target).withColumn("state_id", F.rtrim("state_id"))
    return rows_of(rows, "dt_date", "state_id", "qty", "dt_load")


def test_upsert_rules_and_replay(spark, target):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    first = guarded_upsert(spark, of_cases(spark, 0), target)
    assert (first.received, first.applied, first.superseded, first.without_key) == (8, 8, 0, 0)
    guarded_upsert(spark, of_cases(spark, 1), target)
    expected = rows_of(of_cases(spark, 2))
    assert stored(spark, target) == expected
    guarded_upsert(spark, of_cases(spark, 1), target)
    assert stored(spark, target) == expected
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"


def test_upsert_duplicates_and_missing_keys(spark, target):
    batch = counts(
        spark,
        (DAY, "A", 1, 1), (DAY, "A", 2, 3), (DAY, "A", 3, 2), (DAY, "A", 9, None),
        (None, "A", 5, 1), (DAY, None, 5, 1),
    )
    rejected = f"{target}_rejected"
    columns = rejected_columns("dt_date DATE, state_id STRING, qty INT, dt_load TIMESTAMP_NTZ")
    create_table(spark, rejected, columns, partition_by=[BATCH_KEY])
    report = guarded_upsert(spark, batch, target, rejected=rejected)
    # Sent again, the batch keeps its rejected rows once.
    guarded_upsert(spark, batch.repartition(3), target, rejected=rejected)
    assert (report.received, report.without_key, report.superseded, report.applied) == (6, 2, 3, 1)
    assert rows_of(spark.table(rejected), "dt_date", "qty") == [(None, 5), (DAY, 5)]
    assert stored(spark, target) == [(DAY, "A", 2, at(3))]


def test_upsert_rewrites_only_touched_dates(spark, target):
    guarded_upsert(spark, counts(spark, (DAY, "A", 1, 1), (NEXT, "A", 1, 1)), target)
    before = set(spark.table(target).where(F.col("dt_date") == DAY).inputFiles())
    guarded_upsert(spark, counts(spark, (NEXT, "A", 2, 2)), target)
    assert set(spark.table(target).where(F.col("dt_date") == DAY).inputFiles()) == before
    assert stored(spark, target) == [(DAY, "A", 1, at(1)), (NEXT, "A", 2, at(2))]


def test_listed_dates_prune_partitions(spark, target):
    guarded_upsert(spark, counts(spark, (DAY, "A", 1, 1), (NEXT, "A", 1, 1)), target)
    touched = spark.table(target).where(F.col("dt_date").isin([NEXT]))
    assert "PartitionFilters: [isnotnull(dt_date" in touched._jdf.queryExecution().toString()
    assert len(touched.inputFiles()) == 1


def test_upsert_scans_only_the_dates_between_the_bounds(spark, target):
    days = [DAY + dt.timedelta(days=i) for i in range(8)]
    guarded_upsert(spark, counts(spark, *[(day, "A", 1, 1) for day in days]), target)
    before = set(spark.table(target).where(F.col("dt_date").isin(days[0], days[4])).inputFiles())
    report = guarded_upsert(spark, counts(spark, *[(day, "A", 2, 2) for day in days[2:4] + days[5:]]), target)
    assert (report.inserted, report.updated, report.stale) == (0, 5, 0)
    assert set(spark.table(target).where(F.col("dt_date").isin(days[0], days[4])).inputFiles()) == before
    changed = {days[i] for i in (2, 3, 5, 6, 7)}
    expected = [(day, "A", 2 if day in changed else 1, at(2 if day in changed else 1)) for day in days]
    assert stored(spark, target) == expected


def test_upserts_of_two_threads_keep_all_rows(spark, database):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    columns = "state_id CHAR(3), qty INT, dt_load TIMESTAMP_NTZ, dt_date DATE"
    targets = [f"{database}.one", f"{database}.two"]
    for name in targets:
        create_table(spark, name, columns, partition_by=["dt_date"])

    def load(name):
        for i in range(4):
            guarded_upsert(spark, counts(spark, (DAY + dt.timedelta(days=i), "A", i, 1)), name)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(load, targets))
    for name in targets:
        assert rows_of(spark.table(name), "qty") == [(0,), (1,), (2,), (3,)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"


def test_upsert_report_tells_what_happened(spark, target):
    guarded_upsert(spark, counts(spark, (DAY, "A", 1, 5), (DAY, "B", 1, 5), (DAY, "C", 1, 5)), target)
    files = set(spark.table(target).inputFiles())
    stale = guarded_upsert(spark, counts(spark, (DAY, "A", 9, 1), (DAY, "B", 1, 5)), target)
    assert (stale.applied, stale.stale, stale.unchanged) == (0, 1, 1)
    # Nothing changed, so nothing was written.
    assert set(spark.table(target).inputFiles()) == files
    mixed = guarded_upsert(spark, counts(spark, (DAY, "A", 9, 6), (DAY, "D", 1, 1), (DAY, "C", 9, None)), target)
    assert (mixed.inserted, mixed.updated, mixed.stale) == (1, 1, 1)


def test_the_partition_is_part_of_the_key(spark, target):
    with pytest.raises(ValueError, match="dt_date"):
        guarded_upsert(spark, counts(spark, (DAY, "A", 1, 1)), target, keys=["state_id"])


def test_empty_upsert_changes_nothing(spark, target):
    guarded_upsert(spark, counts(spark, (DAY, "A", 1, 1)), target)
    report = guarded_upsert(spark, counts(spark, (DAY, "A", 1, 1)).where("false"), target)
    assert (report.received, report.applied) == (0, 0)
    assert stored(spark, target) == [(DAY, "A", 1, at(1))]


def test_upsert_with_one_hot_key(spark, target):
    third = spark.range(30_000).select(
        F.lit(DAY).alias("dt_date"),
        F.when(F.col("id") < 10_000, "HOT").otherwise(F.format_string("S%d", F.col("id") % 50)).alias("state_id"),
        F.col("id").cast("int").alias("qty"),
        (F.lit(at(0).isoformat()).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("dt_load"),
    )
    report = guarded_upsert(spark, third, target)
    assert (report.applied, report.superseded) == (51, 30_000 - 51)
    assert spark.table(target).where("state_id = 'HOT'").first().qty == 9_999


def test_char3_rejects_longer_codes(spark, target):
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        guarded_upsert(spark, counts(spark, (DAY, "LONG", 1, 1)), target)


def test_state_counts_drop_null_and_order(spark):
    items = spark.createDataFrame([("B",), ("A",), (None,), ("A",), ("C",)], "state_id STRING")
    assert [tuple(r) for r in state_counts(items).collect()] == [("A", 2), ("B", 1), ("C", 1)]
    stamped = state_counts(items, at(1), stamped=True)
    assert stamped.columns == ["state_id", "qty", "dt"]
    assert {r.dt for r in stamped.collect()} == {at(1)}


def items(spark, rows):
    return spark.createDataFrame(
        rows, "shk_id STRING, dt STRING, tare_id STRING, isstock STRING, state_id STRING, place_cod STRING"
    )


DAY_ROWS = [
    ("1", "2024-02-03 10:00:00.0", "0", "1", "WWE", "0"),
    ("1", "2024-02-03 11:00:00.0", "0", "0", "PEP", "5"),
    (None, "2024-02-03 11:00:00.0", "7", "1", "WWE", "0"),
    ("2", "2024-02-04 11:00:00.0", None, None, None, None),
    ("3", "no time", "7", "1", "PEP", "1"),
    ("4", None, "8", "1", "PEP", "1"),
]


def test_daily_report_nulls(spark):
    assert rows_of(daily_report(items(spark, DAY_ROWS))) == [
        (None, 2, 2, 0, 2, 0, 0),
        (dt.datetime(2024, 2, 3), 1, 2, 2, 1, 1, 1),
        (dt.datetime(2024, 2, 4), 1, 0, 0, 0, 0, 0),
    ]
    estimated = daily_report(items(spark, DAY_ROWS), approximate=True)
    assert rows_of(estimated) == rows_of(daily_report(items(spark, DAY_ROWS)))


def test_daily_report_of_last_days_pushes_the_bound_down(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = items(spark, DAY_ROWS).withColumn("dt", F.col("dt").try_cast("timestamp_ntz"))
    rows.write.parquet(path)
    report = daily_report(spark.read.parquet(path), last_days=1, as_of=dt.date(2024, 2, 5))
    assert [r[0] for r in rows_of(report)] == [dt.datetime(2024, 2, 4)]
    assert "GreaterThanOrEqual(dt,2024-02-04T00:00" in report._jdf.queryExecution().toString()


def test_distinct_states_unite(spark):
    rows = spark.range(70_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 40_000 - 35_000).alias("v"))
    rows = rows.union(spark.sql("SELECT 1, v FROM VALUES (18023180111), (0), (0), (NULL) AS t(v)"))
    parts = [rows.where("v % 2 = 0"), rows.where("v % 2 = 1"), rows]
    exact = {r.k: r.n for r in rows.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}
    bitmaps = [bitmap_state(part, ["k"], "v") for part in parts]
    united = bitmaps[0].unionByName(bitmaps[1]).unionByName(bitmaps[2])
    assert {r.k: r.n for r in bitmap_totals(united, ["k"], "n").collect()} == exact
    sketches = [sketch_state(part, ["k"], "v") for part in parts]
    estimate = sketch_totals(sketches[0].unionByName(sketches[1]).unionByName(sketches[2]), ["k"], "n")
    assert all(abs(r.n - exact[r.k]) <= 0.05 * exact[r.k] for r in estimate.collect())


def test_record_arrays_are_bounded_and_complete(spark):
    rows = spark.range(0, 10_000, 1, 3).select(F.lit("hot").alias("state_id"), F.col("id").alias("qty"))
    arrays = record_arrays(rows, ["state_id", "qty"], max_records=250)
    assert arrays.select(F.max(F.json_array_length("records"))).first()[0] <= 250
    back = expand_records(arrays, "state_id string, qty bigint")
    assert back.exceptAll(rows).isEmpty() and back.count() == 10_000


def test_expand_records_fields(spark):
    texts = ['[{"a": 1, "x": 2}, {"b": "2024-08-06T08:18:04.000"}]', "[]"]
    arrays = spark.createDataFrame([(text,) for text in texts], "records STRING")
    assert rows_of(expand_records(arrays, "a int, b timestamp_ntz, c date")) == [
        (None, dt.datetime(2024, 8, 6, 8, 18, 4), None),
        (1, None, None),
    ]


def test_strict_records_lose_nothing(spark):
    def records(text, schema="a int, b date"):
        return expand_records(spark.createDataFrame([(text,)], "records STRING"), schema, strict=True)

    assert rows_of(records('[{"a": 1, "b": null}, {"x": 5}]')) == [(None, None), (1, None)]
    for text in ('[{"a": 3000000000}]', '[{"b": "soon"}]', "[{"):
        with pytest.raises(Exception, match="(?i)lost|not an array"):
            records(text).collect()
    assert rows_of(records('[{"a": 3000000000}]', "a bigint")) == [(3_000_000_000,)]
    assert records(None).count() == 0


def test_iso_time_decodes_as_date(spark):
    arrays = spark.createDataFrame([('[{"d": "2024-08-06T08:18:04.000"}]',)], "records STRING")
    assert rows_of(expand_records(arrays, "d date")) == [(DAY,)]


def test_rollup_boundaries_and_default(spark):
    points = spark.createDataFrame(
        [
            ("click_cost", at(0), 1.0, 2), ("click_cost", at(59), 9.0, 1), ("click_cost", at(60), 3.0, 3),
            ("other", at(0), 1.0, 4), ("other", at(59), 9.0, 5), ("other", at(60), 3.0, 6), ("other", at(62), 4.0, 7),
        ],
        "metric STRING, ts TIMESTAMP_NTZ, value DOUBLE, id BIGINT",
    )
    rules = (RollupRule("click_cost", "any", ((0, 3600),)), RollupRule("", "max", ((3600, 600), (0, 60))))
    base = 1722902400
    found = age_rollup(points, rules, F.lit(at(120).isoformat()).cast("timestamp_ntz"))
    assert rows_of(found) == [
        ("click_cost", base, 9.0),
        ("click_cost", base + 3600, 3.0),
        ("other", base, 1.0),
        ("other", base + 3000, 9.0),
        ("other", base + 3600, 3.0),
        ("other", base + 3720, 4.0),
    ]
    with pytest.raises(ValueError):
        RollupRule("x", "sum", ((0, 60),))
    with pytest.raises(ValueError):
        RollupRule("x", "max", ((5, 60),))
