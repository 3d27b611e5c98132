"""Replay-safe loading of a stream into tables.

Spark may run a micro-batch again after a failure. Every batch therefore owns one partition (run_id, batch_id) of its
target and overwrites it; the run is the stream's identity from its checkpoint, so that batch numbers that start
again with a new checkpoint do not collide.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stockroom.streaming.admission import EVERY_SECOND

BATCH_COLUMNS = ["run_id", "batch_id"]


def batch_table_columns(columns: str) -> str:
    """The column list of a table that streams load into."""
    return f"{columns}, run_id STRING, batch_id BIGINT"


def for_each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_SECOND,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``handle(rows, run_id, batch_id)``."""

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        run_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not run_id:
            raise RuntimeError("the stream's identity is unknown, so its batches could not be replayed safely")
        handle(rows, run_id, batch_id)

    return (
        stream.writeStream.foreachBatch(on_batch)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def overwrite_batch(rows: DataFrame, table: str, run_id: str, batch_id: int) -> None:
    """Write a batch into its own partition, replacing what an earlier attempt left there. Binds by column name."""
    spark = rows.sparkSession
    names = ", ".join(f"`{c}`" for c in spark.table(table).columns if c not in BATCH_COLUMNS)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = '{run_id}', batch_id = {int(batch_id)}) "
        f"SELECT {names} FROM {{rows}}",
        rows=rows,
    )


def load_into(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_SECOND,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> StreamingQuery:
    """Load a stream into a table made with :func:`batch_table_columns`, after ``prepare`` on each batch."""
    return for_each_batch(
        stream,
        lambda rows, run_id, batch_id: overwrite_batch(prepare(rows), table, run_id, batch_id),
        checkpoint,
        trigger,
    )
