"""JSON record arrays: rows packed into text for hand-over, and unpacked again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions import iso_record


def record_arrays(rows: DataFrame, columns: Sequence[str], max_records: int = 1000) -> DataFrame:
    """JSON arrays of at most ``max_records`` records each, in the column ``records``.

    Consecutive rows of one input partition share an array, whatever keys they have, so a hot key cannot make one grow.
    Arrays are put together before they are moved.
    """
    numbered = rows.select(
        iso_record(columns).alias("record"), F.floor(F.monotonically_increasing_id() / max_records).alias("run")
    )
    gathered = numbered.groupBy("run").agg(F.array_join(F.collect_list("record"), ",").alias("joined"))
    return gathered.select(F.concat(F.lit("["), "joined", F.lit("]")).alias("records"))


def expand_records(arrays: DataFrame, schema: str, column: str = "records", strict: bool = False) -> DataFrame:
    """One row per record. A field missing from a record is NULL; a field not in the schema is dropped.

    A value that its field's type cannot hold becomes NULL, and text that is no array gives no rows; with ``strict``
    both fail the job instead.
    """
    records = F.from_json(column, f"array<struct<{schema}>>")
    if strict:
        records = _checked(records, F.col(column), [field.name for field in T.StructType.fromDDL(schema).fields])
    return arrays.select(F.inline(records))


def _checked(records: Column, text: Column, fields: Sequence[str]) -> Column:
    """The records, or an error where a value or the whole text was lost in parsing."""
    written = F.from_json(text, "array<map<string,string>>")

    def check(record: Column, values: Column) -> Column:
        lost = [values[name].isNotNull() & record[name].isNull() for name in fields]
        return F.when(reduce(or_, lost), F.raise_error(F.concat(F.lit("a record's value was lost: "), text))).otherwise(
            record
        )

    broken = text.isNotNull() & records.isNull()
    return F.when(broken, F.raise_error(F.concat(F.lit("not an array of records: "), text))).otherwise(
        F.zip_with(records, written, check)
    )
