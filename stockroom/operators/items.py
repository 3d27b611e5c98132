"""From messages to clean, typed item rows. All of it is row-local: no shuffle, batch or stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions import best_effort_timestamp, flag_is_set, message_text, parse_message
from stockroom.schemas import ITEM_COLUMNS, ITEM_FLAGS, ITEM_IDS, ITEM_RAW, ITEM_TIMES

# Fixed value: how a bare NaN in a message reads once decoded into a text field.
DECODED_NAN = '"NaN"'

BROKEN_MESSAGE = "broken_message"


def parse_items(messages: DataFrame, schema: T.StructType = ITEM_RAW) -> DataFrame:
    """The fields of every message. A broken message keeps its row, with NULL in all fields."""
    parsed = messages.select(parse_message(message_text("value"), schema).alias("item"))
    return parsed.select(*[F.col(f"item.{name}").alias(name) for name in schema.names])


def parse_with_quarantine(messages: DataFrame, schema: T.StructType = ITEM_RAW) -> DataFrame:
    """Like :func:`parse_items`, plus ``broken_message``: the text of a message that is no record, else NULL.

    An empty message is broken too, with empty text. One pass serves both outputs: filter on the column, or write
    partitioned by whether it is NULL.
    """
    text = message_text("value")
    with_text = T.StructType([*schema.fields, T.StructField(BROKEN_MESSAGE, T.StringType())])
    parsed = messages.select(text.alias("text"), parse_message(text, with_text, BROKEN_MESSAGE).alias("item"))
    broken = F.when(F.col("item").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.col(f"item.{BROKEN_MESSAGE}"))
    return parsed.select(*[F.col(f"item.{name}").alias(name) for name in schema.names], broken.alias(BROKEN_MESSAGE))


def blank_missing_tare_type(items: DataFrame) -> DataFrame:
    """Replace the decoded NaN of ``tare_type`` by empty text."""
    return items.na.replace([DECODED_NAN], [""], "tare_type")


def _typed_columns() -> Mapping[str, Column]:
    return {
        **{name: F.col(name).try_cast("bigint") for name in ITEM_IDS},
        **{name: best_effort_timestamp(name) for name in ITEM_TIMES},
        **{name: flag_is_set(name) for name in ITEM_FLAGS},
    }


def typed_items(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw text fields in their own types; text that does not convert becomes NULL (see :func:`lost_values`). Of other
    columns those to ``keep`` follow as they are."""
    typed = _typed_columns()
    return items.select(*[typed.get(name, F.col(name)).alias(name) for name in ITEM_COLUMNS], *keep)


def lost_values(items: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Aggregates that count, per column, the non-empty texts that :func:`typed_items` turns into NULL."""
    typed = _typed_columns()
    return [
        F.count_if(F.col(name).isNotNull() & (F.col(name) != "") & typed[name].isNull()).alias(f"{name}_lost")
        for name in (columns or [c for c in items.columns if c in typed])
    ]
