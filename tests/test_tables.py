from __future__ import annotations

import datetime as dt

import pytest
from helpers import ITEM_LINES, rows_of
from pyspark.sql import functions as F

from stockroom import fresh_dir, work_dir
from stockroom.schemas import ITEM_COLUMNS, ITEM_DELIMITED, ITEM_RAW, ITEM_TYPED, OFFICE_TOTALS, STAGING
from stockroom.sinks import (
    append_jdbc,
    append_rows,
    create_layers,
    create_table,
    create_table_as,
    expire_months,
    insert_literals,
    replace_partitions,
    sorted_for,
    write_by_month,
)
from stockroom.sources import scan_delimited, scan_delimited_inferred, scan_table

HEADER = ";".join(ITEM_COLUMNS)
LINES = ITEM_LINES[:2]


@pytest.fixture
def item_file(tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("﻿" + "\n".join([HEADER, *LINES]) + "\n", encoding="utf-8")
    return str(path)


def test_schemas_agree_on_names():
    assert ITEM_RAW.names == ITEM_DELIMITED.names == ITEM_TYPED.names == ITEM_COLUMNS
    assert ITEM_TYPED["isstock"].dataType.simpleString() == "boolean"
    assert ITEM_TYPED["wbsticker_id"].dataType.simpleString() == "bigint"


def test_delimited_file_with_byte_order_mark(spark, item_file):
    rows = scan_delimited(spark, item_file, ITEM_DELIMITED).orderBy("shk_id").collect()
    found = [(r.shk_id, r.tare_type, r.isstock, r.wbsticker_id) for r in rows]
    assert found == [(101, "CON", 0, 17000000101), (102, "", 1, 102)]
    with_nulls = scan_delimited(spark, item_file, ITEM_DELIMITED, empty_as_text=False)
    assert with_nulls.where("tare_type is null").count() == 1


def test_other_header_is_refused(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("\n".join([HEADER.replace("tare_id;tare_type", "tare_type;tare_id"), *LINES]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_delimited(spark, str(path), ITEM_DELIMITED).collect()


def test_quotes_separators_and_line_breaks(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('a;b\n1;"x ""y""; z"\n2;"two\nlines"\n3;\n', encoding="utf-8")
    rows = scan_delimited(spark, str(path), "a BIGINT, b STRING", multi_line=True)
    assert rows_of(rows) == [(1, 'x "y"; z'), (2, "two\nlines"), (3, "")]
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_delimited(spark, str(path), "a BIGINT, b STRING").collect()


@pytest.mark.parametrize("line", ["x;abc", "1", "1;b;c", "99999999999999999999;b"])
def test_rows_that_do_not_fit_fail_or_are_kept(spark, tmp_path, line):
    path = tmp_path / "broken.csv"
    path.write_text(f"a;b\n5;fine\n{line}\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_delimited(spark, str(path), "a BIGINT, b STRING").collect()
    # A bad value in a column that is not asked for is noticed too.
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_delimited(spark, str(path), "a BIGINT, b STRING").select("b").collect()
    rows = scan_delimited(spark, str(path), "a BIGINT, b STRING", keep_broken=True)
    assert [row.broken_line for row in rows.collect() if row.a != 5] == [line]
    assert rows.where("a = 5 and broken_line is null").count() == 1


def test_inferred_file_has_no_nulls(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("﻿id,t,n,s,b\n1,2024-01-01 00:00:00.0,1.5,x,true\n,,,,\n3,2024-01-02 00:00:00.0,2,,false\n")
    rows = scan_delimited_inferred(spark, str(path))
    assert dict(rows.dtypes) == {"id": "bigint", "t": "timestamp_ntz", "n": "double", "s": "string", "b": "boolean"}
    epoch = dt.datetime(1970, 1, 1)
    assert rows_of(rows)[0] == (0, epoch, 0.0, "", False)
    assert rows_of(rows)[2] == (3, dt.datetime(2024, 1, 2), 2.0, "", False)


def test_layers_are_idempotent(spark, tmp_path):
    for _ in range(2):
        names = create_layers(spark, str(tmp_path))
    assert names == ["staging", "current", "history", "log"]
    assert set(names) <= {row[0] for row in spark.sql("SHOW DATABASES").collect()}
    create_table(spark, "current.`table`", OFFICE_TOTALS, sort_key=["office_id"])
    insert_literals(spark, "current.`table`", ["total", "office_id", "is_stock_count"], [(3, 1, 2)])
    assert rows_of(spark.table("current.`table`")) == [(1, 2, 3)]
    assert create_layers(spark, str(tmp_path), prefix="other_")[0] == "other_staging"


def test_create_if_not_exists_keeps_rows(spark, database):
    name = f"{database}.t"
    create_table(spark, name, "a INT")
    insert_literals(spark, name, ["a"], [(1,)])
    create_table(spark, name, "a INT", if_not_exists=True)
    assert rows_of(scan_table(spark, name)) == [(1,)]
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_table(spark, name, "a INT")


def test_insert_binds_by_name_and_allows_equal_keys(spark, database):
    name = f"{database}.t"
    create_table(spark, name, STAGING, sort_key=["shk_id"])
    row = ("2024-06-28 12:05:12", False, 5, 123)
    insert_literals(spark, name, ["dt_load", "is_stock", "shk_id", "office_id"], [row, row])
    assert rows_of(spark.table(name)) == [(5, 123, False, dt.datetime(2024, 6, 28, 12, 5, 12))] * 2


def test_appends_sort_within_files(spark, database):
    name = f"{database}.t"
    create_table(spark, name, "k BIGINT, v BIGINT", sort_key=["k"])
    rows = spark.range(0, 1000, 1, 2).select(F.pmod(F.col("id") * 7919, F.lit(1000)).alias("k"), F.col("id").alias("v"))
    append_rows(spark, name, rows)
    for file in spark.table(name).inputFiles():
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)
    assert spark.table(name).exceptAll(rows).isEmpty() and spark.table(name).count() == 1000


def test_clustering_splits_a_hot_key(spark):
    # Two thirds of the rows are copies of one row.
    rows = spark.range(6000).select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("k")).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid_out = sorted_for(rows, ["k"], clustered=True)
        sizes = [r["count"] for r in laid_out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2700
    assert laid_out.exceptAll(rows).isEmpty() and laid_out.count() == 6000


def test_scan_selects_in_order(spark, database):
    create_table(spark, f"{database}.t", "a INT, b INT, c INT")
    assert scan_table(spark, f"{database}.t", ["c", "a"]).columns == ["c", "a"]


def numbered(spark, times):
    return spark.createDataFrame([(t, i) for i, t in enumerate(times)], "t TIMESTAMP_NTZ, i INT")


def test_month_partitions_prune(spark, database):
    name = f"{database}.log"
    times = [dt.datetime(2024, 1, 31, 23), dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 29), None]
    write_by_month(spark, name, numbered(spark, times), "t")
    write_by_month(spark, name, numbered(spark, times[:1]), "t")
    february = spark.table(name).where("yyyymm = 202402")
    assert rows_of(february, "i") == [(1,), (2,)]
    assert "PartitionFilters: [isnotnull(yyyymm" in february._jdf.queryExecution().toString()
    assert spark.table(name).count() == 5


def test_replaced_partitions_leave_the_others_and_the_session_alone(spark, database):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    name = f"{database}.t"
    create_table(spark, name, "v INT, p STRING", partition_by=["p"])
    replace_partitions(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "p STRING, v INT"), name)
    replace_partitions(spark.createDataFrame([("b", 4), ("b", 5), ("c d/e", 6)], "p STRING, v INT"), name)
    assert rows_of(spark.table(name), "p", "v") == [(None, 3), ("a", 1), ("b", 4), ("b", 5), ("c d/e", 6)]
    # Rows of the table itself may replace it.
    replace_partitions(spark.table(name).where("p = 'b' and v = 5"), name)
    assert rows_of(spark.table(name), "v") == [(1,), (3,), (5,), (6,)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"


@pytest.mark.parametrize(
    ("as_of", "kept", "dropped"),
    [
        (dt.date(2024, 3, 11), [2, 3, 4], 1),
        (dt.date(2024, 3, 31), [3, 4], 2),
        (dt.date(2025, 1, 1), [4], 3),
        (dt.date(2024, 1, 1), [0, 1, 2, 3, 4], 0),
    ],
)
def test_expiry_keeps_the_boundary_day(spark, database, as_of, kept, dropped):
    name = f"{database}.log"
    days = [dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 9, 23, 59), dt.datetime(2024, 2, 10)]
    times = [*days, dt.datetime(2024, 3, 1), None]
    write_by_month(spark, name, numbered(spark, times), "t")
    assert expire_months(spark, name, "t", 30, as_of) == dropped
    assert rows_of(spark.table(name), "i") == [(i,) for i in kept]


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    assert fresh_dir(spark, "x").startswith(work_dir(spark))


def test_jdbc_append_needs_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        append_jdbc(spark.range(1), "jdbc:none://nowhere/db", "t")


def scanned_rows(rows):
    """How many rows the scan of a table hands on, from the metrics of the plan that ran."""
    rows.collect()
    leaves = rows._jdf.queryExecution().executedPlan().collectLeaves()
    plans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(plan.metrics().apply("numOutputRows").value() for plan in plans)


def test_point_lookup_beside_the_sort_key(spark, database):
    # Every file holds the whole range of the second key, so only its filter can tell which file has a value.
    rows = spark.range(0, 80_000, numPartitions=8).select(
        F.col("id").alias("shk_id"), (F.col("id") * 7919 % 80_000).alias("tare_id")
    )
    found = {}
    for name, lookup in (("plain", None), ("filtered", {"tare_id": 10_000})):
        create_table_as(spark, f"{database}.{name}", rows, sort_key=["shk_id"], lookup=lookup)
        with_key = spark.table(f"{database}.{name}").where("tare_id = 40001")
        assert [row["shk_id"] * 7919 % 80_000 for row in with_key.collect()] == [40001]
        found[name] = scanned_rows(with_key)
        append_rows(spark, f"{database}.{name}", rows.where("tare_id < 10"))
    assert found["plain"] == 80_000 and found["filtered"] <= 30_000
    again = spark.table(f"{database}.filtered").where("tare_id = 3")
    assert again.count() == 2
