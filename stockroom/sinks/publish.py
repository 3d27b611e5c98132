"""Publishing rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions import datetime_text, message
from stockroom.sources.topics import Topic


def as_messages(rows: DataFrame) -> DataFrame:
    """One JSON message per row in the column ``value``; times as text, so that no digit is lost, nested ones too."""
    fields = [_with_time_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rows.schema.fields]
    return rows.select(message(fields).alias("value"))


def _with_time_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return datetime_text(value)
    if isinstance(kind, T.StructType):
        fields = [_with_time_text(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _with_time_text(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _with_time_text(x, kind.valueType))
    return value


def publish(rows: DataFrame, topic: Topic) -> int:
    """Write every row to the topic and return how many messages were written.

    The count is taken while writing. A message that cannot be delivered fails its task and, after retries, the job.
    """
    written = Observation()
    topic.append(as_messages(rows).observe(written, F.count("*").alias("messages")))
    return written.get["messages"]
