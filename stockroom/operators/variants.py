"""Records without a fixed schema: every field is kept as it came, and typed when it is asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "record"


def loose_records(rows: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON texts as records of any fields: ``record`` (a variant) and ``broken`` (the text, if it is no JSON).

    An array gives a row for each element, in the place ``at``; an empty array gives none. Anything else is one record.
    Numbers of up to 38 digits stay exact. NULL gives a row without a record.
    """
    text = F.col(column).cast("string")
    parsed = F.try_parse_json(text)
    whole = rows.select(
        *keep,
        parsed.alias("whole"),
        F.when(text.isNotNull() & parsed.isNull(), text).alias("broken"),
        # An array as pieces; anything else as one.
        F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.array(parsed)).alias("pieces"),
    )
    return whole.select(*keep, "broken", F.posexplode("pieces").alias("at", RECORD))


def fields_of(record: Column | str) -> Column:
    """A record's fields by name, as variants; NULL for what is no object."""
    return F.try_variant_get(F.col(record) if isinstance(record, str) else record, "$", "map<string,variant>")


def field(fields: Column, name: str, kind: str = "string") -> Column:
    """One of :func:`fields_of` with the given SQL type; NULL if it is missing or has no such value.

    Text becomes a zone-less time by a cast from text, as JSON has no times.
    """
    if kind.lower() == "timestamp_ntz":
        return F.try_variant_get(fields[name], "$", "string").try_cast("timestamp_ntz")
    return F.try_variant_get(fields[name], "$", kind)


def typed_records(records: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Records with the fields of ``schema`` as columns, and ``unknown``: the other fields, as a map of JSON texts.

    ``lost`` names the fields of the schema that are in the record, are not null there, and do not fit their type.
    """
    wanted = T.StructType.fromDDL(schema).fields
    fields = fields_of(RECORD)
    names = F.array(*[F.lit(f.name) for f in wanted])
    unknown = F.map_filter(fields, lambda name, _: ~F.array_contains(names, name))
    given = {f.name: field(fields, f.name, f.dataType.simpleString()) for f in wanted}
    lost = F.array_compact(
        F.array(
            *[
                F.when(value.isNull() & fields[name].isNotNull() & ~F.is_variant_null(fields[name]), F.lit(name))
                for name, value in given.items()
            ]
        )
    )
    return records.select(
        *keep,
        *[value.alias(name) for name, value in given.items()],
        F.transform_values(unknown, lambda _, value: F.to_json(value)).alias("unknown"),
        lost.alias("lost"),
    )


def observed_fields(records: DataFrame) -> DataFrame:
    """(name, type, records) of all fields met, one row for each name and type: what a schema would have to hold."""
    fields = F.map_entries(fields_of(RECORD))
    met = records.select(F.explode(fields).alias("entry")).select(
        F.col("entry.key").alias("name"), F.schema_of_variant(F.col("entry.value")).alias("type")
    )
    return met.groupBy("name", "type").agg(F.count("*").alias("records"))
