"""The list of this subpackage's check queries and what they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

ROW = "whole_row"

#: Rows and bytes of one Arrow batch. Texts may have millions of characters, so batches are bounded by size.
ARROW_ROWS = 1024
ARROW_BYTES = 2 << 20


@dataclass(frozen=True)
class Check:
    """A query and, where SQL can express it, SQL that gives the same rows."""

    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated query under its function name."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return query(spark, sf_dir)

        CHECKS[query.__name__] = Check(run, sql)
        return query

    return register


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get a few megabytes at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, label: str, few: bool = False, gathered: bool = False) -> DataFrame:
    """The rows, written once to the shared folder and read from there, so that no later loss recomputes them.

    ``few`` is for rows that are little beside the documents, such as links: an eighth of the usual files hold them.
    ``gathered`` is for such rows if they take much work: all tasks share it, and then the rows move to so many files. On
    a local disk Hadoop starts helper processes for each file, and an executor's memory counts twice while one starts.
    """
    spark = rows.sparkSession
    path = fresh_dir(spark, label)
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    if gathered:
        rows = rows.repartition(files)
    elif few:
        rows = rows.coalesce(files)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def in_fewer_files(rows: DataFrame, share: int) -> DataFrame:
    """For rows that take little work where they are written: one in ``share`` of the usual files holds them, but no fewer
    tasks write them than there are cores. Many short tasks that each begin a file are where helper processes crowd."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.coalesce(max(spark.sparkContext.defaultParallelism, parts // share))


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders that :func:`stored` or a table has written, when nothing reads them any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def packed(rows: DataFrame, without: str | None = None) -> Column:
    """All columns as one, so that their names meet no others while something is worked out beside them."""
    kept = [F.col(f"`{name}`").alias(f"c{at}") for at, name in enumerate(rows.columns) if name != without]
    return F.struct(F.lit(0).alias("none"), *kept).alias(ROW)


def unpacked(rows: DataFrame, replaced: dict[str, Column]) -> list[Column]:
    """The columns of ``rows`` again, some of them replaced or, if new, added."""
    own = [
        replaced[name].alias(name) if name in replaced else F.col(f"{ROW}.c{at}").alias(name)
        for at, name in enumerate(rows.columns)
    ]
    return [*own, *[value.alias(name) for name, value in replaced.items() if name not in rows.columns]]
