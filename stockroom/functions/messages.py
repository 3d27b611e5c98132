"""JSON messages: rows to message text and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def datetime_text(c: Column | str) -> Column:
    """A time as text with all its digits; writing the time itself to JSON would cut it to milliseconds."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def message(columns: Sequence[Column | str]) -> Column:
    """One row as a UTF-8 JSON object. A NULL field is written as ``null``, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")


def iso_record(columns: Sequence[Column | str]) -> Column:
    """One row as JSON text with ISO times of millisecond precision, for record-set hand-over."""
    options = {"ignoreNullFields": "false", "timestampNTZFormat": ISO_MILLIS, "timestampFormat": ISO_MILLIS}
    return F.to_json(F.struct(*columns), options)


def message_text(value: Column | str) -> Column:
    """Message bytes as UTF-8 text."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def parse_message(text: Column, schema: T.StructType | str, corrupt_column: str | None = None) -> Column:
    """Message text as a struct. A broken message gives NULL fields; with ``corrupt_column`` its text is kept there.

    A schema with only the fields that are needed makes parsing cheaper.
    """
    if corrupt_column is None:
        return F.from_json(text, schema)
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column})
