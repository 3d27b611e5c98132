"""Month partitions and retention."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockroom.functions import year_month
from stockroom.sinks.tables import create_table

MONTH = "yyyymm"

# Fixed value: how the catalog and the file system write a missing partition value.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def write_by_month(spark: SparkSession, table: str, rows: DataFrame, time: str) -> None:
    """Append to a table partitioned by the month of ``time``; the table is created if missing.

    A filter on the column ``yyyymm`` prunes whole months. Rebalancing gives every month few files and splits a month
    that is too large for one task.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    create_table(spark, table, f"{columns}, {MONTH} INT", partition_by=[MONTH], if_not_exists=True)
    placed = rows.withColumn(MONTH, year_month(time)).hint("rebalance", MONTH)
    placed.select(*spark.table(table).columns).write.insertInto(table)


def partition_values(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """The table's partitions from the catalog, without reading data."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [dict(part.split("=", 1) for part in row["partition"].split("/")) for row in rows]


def drop_partitions(spark: SparkSession, table: str, drop: Callable[[dict[str, str]], bool]) -> int:
    """Drop the partitions for which ``drop`` holds, with their files; return how many."""
    doomed = [part for part in partition_values(spark, table) if drop(part)]
    specs = [", ".join(f"{name}='{value}'" for name, value in part.items()) for part in doomed]
    for start in range(0, len(specs), 500):
        clauses = ", ".join(f"PARTITION ({spec})" for spec in specs[start : start + 500])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {clauses}")
    return len(doomed)


def replace_partitions(rows: DataFrame, table: str) -> None:
    """Overwrite the partitions of ``table`` that ``rows`` has rows of, and no others.

    The files are written by path, with the overwrite mode as an option of this write: a table insert takes the mode from
    the session, where other writes would see it. The write itself tells which partitions it has met, and only these are
    made known to the catalog, so what the table holds besides is not listed.
    """
    spark = rows.sparkSession
    described = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    keys = described["partition_columns"]
    met = Observation()
    texts = [F.col(f"`{key}`").cast("string").alias(f"p{at}") for at, key in enumerate(keys)]
    rows = rows.select(*[F.col(f"`{name}`") for name in spark.table(table).columns])
    rows = rows.observe(met, F.collect_set(F.struct(*texts)).alias("partitions"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(
        described["location"]
    )
    add_partitions(spark, table, [dict(zip(keys, values, strict=True)) for values in met.get["partitions"]])
    spark.catalog.refreshTable(table)


def add_partitions(spark: SparkSession, table: str, partitions: list[dict[str, str | None]]) -> None:
    """Make partitions known to the catalog, if they are not."""

    def clause(part: dict[str, str | None]) -> str:
        # Empty text and NULL are one partition.
        values = {key: value.replace("\\", "\\\\").replace("'", "\\'") if value else None for key, value in part.items()}
        return ", ".join(f"`{key}` = " + ("NULL" if value is None else f"'{value}'") for key, value in values.items())

    clauses = [f"PARTITION ({clause(part)})" for part in partitions]
    for start in range(0, len(clauses), 500):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(clauses[start : start + 500])}")


def expire_months(spark: SparkSession, table: str, time: str, days: int, as_of: dt.date) -> int:
    """Remove rows whose day is more than ``days`` days before ``as_of``; return the number of months dropped whole.

    Whole months are dropped without reading them. Only the month of the boundary day is rewritten.
    """
    first_kept = as_of - dt.timedelta(days=days)
    boundary = first_kept.year * 100 + first_kept.month

    def is_older(part: dict[str, str]) -> bool:
        return part[MONTH].isdigit() and int(part[MONTH]) < boundary

    dropped = drop_partitions(spark, table, is_older)
    rows = spark.table(table).where(F.col(MONTH) == boundary)
    kept = rows.where(F.col(time).cast("date") >= F.lit(first_kept.isoformat()).cast("date"))
    if kept.isEmpty():
        drop_partitions(spark, table, lambda part: part[MONTH] == str(boundary))
    elif first_kept.day > 1:
        replace_partitions(kept, table)
    return dropped
