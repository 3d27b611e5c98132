"""What became of every micro-batch of a load, as rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockroom.sinks.tables import create_table
from stockroom.streaming.loading import BATCH_COLUMNS, batch_table_columns, overwrite_batch

#: Rows that a batch brought, that were loaded, and whose text went to the quarantine.
ACCOUNT = "rows_read BIGINT, loaded BIGINT, broken BIGINT, accounted_at TIMESTAMP"


def create_accounts(spark: SparkSession, table: str) -> None:
    """The table of accounts, one row for each batch, if it is missing."""
    create_table(spark, table, batch_table_columns(ACCOUNT), partition_by=BATCH_COLUMNS, if_not_exists=True)


def counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and how many there were (``rows``) once they have been written: the write counts them itself."""
    seen = Observation()
    return rows.observe(seen, F.count("*").alias("rows")), seen


def keep_account(
    spark: SparkSession, table: str, run_id: str, batch_id: int, rows_read: int, loaded: int, broken: int
) -> None:
    """A batch's row. A batch that is run again replaces it, as it replaces what it has loaded."""
    row = spark.range(1).select(
        F.lit(rows_read).cast("bigint").alias("rows_read"),
        F.lit(loaded).cast("bigint").alias("loaded"),
        F.lit(broken).cast("bigint").alias("broken"),
        F.current_timestamp().alias("accounted_at"),
    )
    overwrite_batch(row, table, run_id, batch_id)


def accounts(spark: SparkSession, table: str) -> DataFrame:
    """All accounts: what was read is what was loaded or is broken, or the batch is ``open``."""
    spark.catalog.refreshTable(table)
    is_open = F.col("rows_read") != F.col("loaded") + F.col("broken")
    return spark.table(table).withColumn("open", is_open)
