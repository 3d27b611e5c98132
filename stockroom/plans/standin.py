"""The test tables read as inventory data.

The tables given for testing hold no inventory, so ``events`` stands in: an event is an item, its user the employee,
office and container, its type the item's state. Each mapping is also given as SQL for the checks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.schemas import ITEM_COLUMNS
from stockroom.session import fresh_dir

STATES = {"error": "WWE", "purchase": "BRA", "view": "FOS", "click": "FRS", "signup": "PEP"}
TARE_TYPES = {"view": "", "click": "", "purchase": "BOX", "signup": "CON", "error": "TBX"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_type(names: dict[str, str]):
    return F.expr("CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as items in the delimited layer: numbers, with times and codes as text."""
    has_tare = F.col("event_type").isin("purchase", "signup", "error")
    columns = {
        "shk_id": F.col("event_id"),
        "dt": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.0"),
        "employee_id": F.col("user_id"),
        "place_cod": F.regexp_extract("props", "[0-9]+", 0).cast("bigint"),
        "tare_id": F.when(has_tare, F.col("user_id")).otherwise(0).cast("bigint"),
        "tare_type": _by_type(TARE_TYPES),
        "isdeleted": (F.col("value") == 0).cast("bigint"),
        "isstock": (F.col("event_type") == "purchase").cast("bigint"),
        "chrt_id": F.floor(F.col("value") * 100).cast("bigint"),
        "state_id": _by_type(STATES),
        "transfer_box_id": F.when(F.col("event_type") == "error", F.col("user_id")).otherwise(0).cast("bigint"),
        "correction_dt": F.when(F.col("event_type") == "signup", "1970-01-01 07:00:00.0").otherwise(
            "2000-01-01 03:00:00.0"
        ),
        "wbsticker_id": F.col("event_id") + F.lit(18_000_000_000),
    }
    return table(spark, sf_dir, "events").select(*[columns[name].alias(name) for name in ITEM_COLUMNS])


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every field as text."""
    return items(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in ITEM_COLUMNS])


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as staging rows of items in offices."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("shk_id"),
        F.col("user_id").alias("office_id"),
        (F.col("event_type") == "purchase").alias("is_stock"),
        F.col("ts").alias("dt_load"),
    )


def _sql_by_type(names: dict[str, str]) -> str:
    return "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in names.items()) + " end"


ITEMS_SQL = f"""
select event_id as shk_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') || '.0' as dt,
       user_id as employee_id,
       cast(regexp_extract(props, '[0-9]+') as bigint) as place_cod,
       case when event_type in ('purchase', 'signup', 'error') then user_id else 0 end as tare_id,
       {_sql_by_type(TARE_TYPES)} as tare_type,
       cast(value = 0 as bigint) as isdeleted,
       cast(event_type = 'purchase' as bigint) as isstock,
       cast(floor(value * 100) as bigint) as chrt_id,
       {_sql_by_type(STATES)} as state_id,
       case when event_type = 'error' then user_id else 0 end as transfer_box_id,
       case when event_type = 'signup' then '1970-01-01 07:00:00.0' else '2000-01-01 03:00:00.0' end as correction_dt,
       event_id + 18000000000 as wbsticker_id
from events
"""


def spread_over_files(spark: SparkSession, rows: DataFrame, split: str, label: str) -> str:
    """Write rows into one folder per value of ``split``, without a shuffle, and return the path."""
    path = fresh_dir(spark, label)
    rows.write.partitionBy(split).parquet(path)
    return path


def files_per_batch(spark: SparkSession, path: str, batches: int) -> int:
    """The file limit that makes a stream over ``path`` take ``batches`` batches, however large the folder is."""
    return math.ceil(len(spark.read.parquet(path).inputFiles()) / batches)
