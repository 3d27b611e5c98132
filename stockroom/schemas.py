"""Schemas of the inventory tables.

An item on a storage place exists in three layers:

* raw: every field is text, as decoded from a message;
* delimited: ids and flags are numbers, times and codes are text, as written in a delimited file;
* typed: times and flags have their own types.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The item record's field names, in record order.
ITEM_COLUMNS = [
    "shk_id",
    "dt",
    "employee_id",
    "place_cod",
    "tare_id",
    "tare_type",
    "isdeleted",
    "isstock",
    "chrt_id",
    "state_id",
    "transfer_box_id",
    "correction_dt",
    "wbsticker_id",
]

ITEM_TIMES = ["dt", "correction_dt"]
ITEM_FLAGS = ["isdeleted", "isstock"]
ITEM_CODES = ["tare_type", "state_id"]
ITEM_IDS = [c for c in ITEM_COLUMNS if c not in ITEM_TIMES + ITEM_FLAGS + ITEM_CODES]


def _item(ids: T.DataType, times: T.DataType, flags: T.DataType) -> T.StructType:
    kinds = {
        **dict.fromkeys(ITEM_IDS, ids),
        **dict.fromkeys(ITEM_TIMES, times),
        **dict.fromkeys(ITEM_FLAGS, flags),
        **dict.fromkeys(ITEM_CODES, T.StringType()),
    }
    return T.StructType([T.StructField(name, kinds[name]) for name in ITEM_COLUMNS])


# Ids exceed 32 bits, so they are long in every numeric layer.
ITEM_RAW = _item(T.StringType(), T.StringType(), T.StringType())
ITEM_DELIMITED = _item(T.LongType(), T.StringType(), T.LongType())
ITEM_TYPED = _item(T.LongType(), T.TimestampNTZType(), T.BooleanType())

# Names and types of the remaining tables.
STAGING_COLUMNS = {"shk_id": "BIGINT", "office_id": "BIGINT", "is_stock": "BOOLEAN", "dt_load": "TIMESTAMP_NTZ"}
STAGING = ", ".join(f"{name} {kind}" for name, kind in STAGING_COLUMNS.items())
OFFICE_TOTALS = "office_id BIGINT, is_stock_count BIGINT, total BIGINT"
REPORTS = "state_id STRING, qty BIGINT, dt TIMESTAMP_NTZ"
# Quantities are long: a frequent state has more items than 32 bits count.
STATE_COUNTS_BY_DAY = "dt_date DATE, state_id CHAR(3), qty BIGINT, dt_load TIMESTAMP_NTZ"
LAYERS = ["staging", "current", "history", "log"]
