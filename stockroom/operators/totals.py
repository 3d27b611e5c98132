"""Counts by state and stock totals by office.

Both are counts, which Spark combines before the shuffle: a hot state or office costs one partial row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions import count_if, now


def state_counts(
    items: DataFrame, as_of: dt.datetime | None = None, stamped: bool = False, ordered: bool = True
) -> DataFrame:
    """Items per non-NULL state, most frequent first. ``stamped`` adds the column ``dt`` with one load time.

    A table keeps no order of its rows, so on the way into one there is no need to sort (``ordered=False``).
    """
    counts = items.where(F.col("state_id").isNotNull()).groupBy("state_id").agg(F.count("*").alias("qty"))
    if stamped:
        counts = counts.withColumn("dt", now(as_of)).select("state_id", "qty", "dt")
    return counts.orderBy(F.desc("qty"), "state_id") if ordered else counts


def office_totals(staging: DataFrame) -> DataFrame:
    """Items in stock and all items, per office. The totals of parts of the rows add up to the totals of all."""
    return staging.groupBy("office_id").agg(
        count_if(F.col("is_stock")).alias("is_stock_count"),
        F.count("*").alias("total"),
    )
