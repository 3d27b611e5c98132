"""Totals kept up to date by a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockroom.operators.totals import office_totals
from stockroom.streaming.admission import EVERY_SECOND
from stockroom.streaming.loading import for_each_batch, overwrite_batch
from stockroom.streaming.state import MergeableState


def office_state(table: str) -> MergeableState:
    return MergeableState(
        table, {"office_id": "BIGINT"}, {"is_stock_count": ("BIGINT", "sum"), "total": ("BIGINT", "sum")}
    )


def keep_office_totals(
    staging: DataFrame,
    state: MergeableState,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_SECOND,
    staging_table: str | None = None,
) -> StreamingQuery:
    """Add each batch's totals per office to the state, and the batch itself to ``staging_table`` if given."""

    def handle(rows: DataFrame, run_id: str, batch_id: int) -> None:
        add_office_totals(rows, state, run_id, batch_id, staging_table)

    return for_each_batch(staging, handle, checkpoint, trigger)


def add_office_totals(
    rows: DataFrame, state: MergeableState, run_id: str, batch_id: int, staging_table: str | None = None
) -> None:
    """Add one batch; with a staging table it is stored first, and what was stored is counted."""
    if staging_table:
        overwrite_batch(rows, staging_table, run_id, batch_id)
        stored = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
        rows = rows.sparkSession.table(staging_table).where(stored)
    state.add(office_totals(rows), run_id, batch_id)


#: A state row holds what the aggregates of :func:`office_totals` have added up, in their order.
TOTALS = "struct<is_stock_count:bigint,total:bigint>"


def running_office_totals(
    staging: DataFrame, checkpoint: str, trigger: Mapping[str, object] = EVERY_SECOND
) -> StreamingQuery:
    """Totals that Spark keeps itself: the stream's state is a row for each office, below its checkpoint.

    Read them with :func:`latest_totals`. A batch that is run again, or goes on after a restart, adds nothing twice, as state
    and offsets are committed together. A stream with a new checkpoint starts over.
    """
    return (
        office_totals(staging)
        .writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def latest_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The totals of every office, as of the last committed batch or an earlier one that Spark still keeps."""
    state = spark.read.format("statestore")
    if batch_id is not None:
        state = state.option("batchId", batch_id)
    # By position: the names of the aggregates' buffers repeat.
    totals = F.col("value").cast(TOTALS).alias("totals")
    return state.load(checkpoint).select("key.office_id", totals).select("office_id", "totals.*")
