"""The daily quality report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions import (
    approx_unique,
    best_effort_timestamp,
    count_if_value,
    since_days,
    start_of_day,
    text_is,
    unique,
)

# Report column, the item field it tests and the text that counts.
CONDITIONS = {
    "qty_shk_without_tare": ("tare_id", "0"),
    "qty_shk_stock": ("isstock", "1"),
    "qty_shk_wwe": ("state_id", "WWE"),
    "qty_shk_without_pc": ("place_cod", "0"),
}


def condition_counts():
    return [count_if_value("shk_id", text_is(c, text)).alias(name) for name, (c, text) in CONDITIONS.items()]


def with_day(items: DataFrame, last_days: int | None = None, as_of: dt.date | None = None) -> DataFrame:
    """Add ``dt_day``, NULL where ``dt`` is no time; optionally keep only the last days.

    A ``dt`` that is a time already is used as it is, and then the filter is pushed down to the scan.
    """
    time = best_effort_timestamp("dt") if dict(items.dtypes)["dt"] == "string" else F.col("dt")
    if last_days is not None:
        items = items.where(since_days(time, last_days, as_of))
    return items.withColumn("dt_day", start_of_day(time))


def daily_report(
    items: DataFrame, approximate: bool = False, last_days: int | None = None, as_of: dt.date | None = None
) -> DataFrame:
    """Different items and containers, and four conditional item counts, per day.

    Exact distinct counts are planned by Spark as a shuffle on (day, value), which spreads a hot day over all tasks.
    ``approximate`` replaces that by constant-size sketches combined before the shuffle.
    """
    different = approx_unique if approximate else unique
    return (
        with_day(items, last_days, as_of)
        .groupBy("dt_day")
        .agg(
            different("shk_id").alias("qty_shk"),
            different("tare_id").alias("qty_tare"),
            *condition_counts(),
        )
    )
