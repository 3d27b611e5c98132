"""Table definition and appends.

A table's sort key is a layout, not a uniqueness rule. It is kept as a table property, and every append sorts its own
files by it, so that Parquet's row-group statistics can skip data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.schemas import LAYERS

SORT_KEY = "stockroom.sort_key"
PLACE = "read_by_task"


def create_layers(spark: SparkSession, location: str | None = None, prefix: str = "") -> list[str]:
    """Create the layer databases that do not exist yet, and return their names."""
    names = [f"{prefix}{layer}" for layer in LAYERS]
    for name in names:
        place = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    return names


def create_table(
    spark: SparkSession,
    table: str,
    columns: str,
    sort_key: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    if_not_exists: bool = False,
    lookup: Mapping[str, int] | None = None,
) -> None:
    """An empty table with the given column list (SQL types) and layout.

    ``lookup`` names columns by which single rows are looked for beside the sort key, with how many different values a
    file may hold. Every file then carries a Bloom filter of such a column (about ten bits a value), so that a search for a
    value skips row groups that lack it, however the rows are sorted. More values than stated only make it skip less.
    """
    options = {}
    for name, values in (lookup or {}).items():
        # The file format's option names.
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(int(values))
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in options.items())
    spark.sql(
        f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{table} ({columns}) USING parquet"
        + (f" OPTIONS ({listed})" if options else "")
        + (f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else "")
        + (f" TBLPROPERTIES ('{SORT_KEY}' = '{','.join(sort_key)}')" if sort_key else "")
    )


def create_table_as(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    sort_key: Sequence[str] = (),
    lookup: Mapping[str, int] | None = None,
) -> None:
    """A new table holding ``rows``, with their columns and the given layout."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    create_table(spark, table, columns, sort_key, lookup=lookup)
    append_rows(spark, table, rows)


def sorted_for(rows: DataFrame, sort_key: Sequence[str], clustered: bool = False) -> DataFrame:
    """Rows sorted by the key within every output file.

    Normally nothing moves between tasks: each file covers all keys but its row groups do not. With ``clustered`` each
    file also holds only its own key range, at the price of a sampling pass and a shuffle.

    A hot key, even one whose rows are all copies, is cut into several ranges: the range order continues with the
    number of the task that read the row, which is the same when the task is run again.
    """
    if not sort_key:
        return rows
    if clustered:
        rows = rows.withColumn(PLACE, F.spark_partition_id())
        rows = rows.repartitionByRange(*sort_key, PLACE).drop(PLACE)
    return rows.sortWithinPartitions(*sort_key)


def append_rows(spark: SparkSession, table: str, rows: DataFrame, clustered: bool = False) -> None:
    """Append by column name, whatever order the columns have. Executors write; nothing passes through the driver."""
    target = spark.table(table)
    names = [f"`{name}`" for name in target.columns]
    sorted_for(rows.select(*names), _sort_key(spark, table), clustered).write.insertInto(table)


def _sort_key(spark: SparkSession, table: str) -> list[str]:
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == SORT_KEY).collect()
    return properties[0]["value"].split(",") if properties else []


def insert_literals(spark: SparkSession, table: str, columns: Sequence[str], rows: Sequence[Sequence[object]]) -> None:
    """Insert a few literal rows given in an order of columns other than the table's."""
    types = {field.name: field.dataType for field in spark.table(table).schema.fields}
    values = spark.createDataFrame([tuple(row) for row in rows], list(columns))
    append_rows(spark, table, values.select(*[F.col(c).cast(types[c]).alias(c) for c in columns]))


def append_jdbc(rows: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """Append to a database table over JDBC, one connection per task. The driver jar comes with spark-submit."""
    rows.write.format("jdbc").options(url=url, dbtable=table, **(options or {})).mode("append").save()
