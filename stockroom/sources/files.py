"""Delimited text files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.sources.records import scan_records

BROKEN_LINE = "broken_line"


def scan_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ";",
    empty_as_text: bool = True,
    multi_line: bool = False,
    keep_broken: bool = False,
) -> DataFrame:
    """Read with a given schema. Empty text fields become ``''`` rather than NULL.

    The header has to name the schema's columns in their order, or the read fails. A quote inside a quoted field is
    doubled. A row with too few or too many fields, or with a value that its column cannot hold, fails the read; with
    ``keep_broken`` its text is kept in ``broken_line``, which is NULL for all other rows. All columns are read, so that
    no bad value stays unnoticed. Files are split by byte range, also if fields may have line breaks (``multi_line``); they
    are read twice then.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [field.name for field in schema.fields]
    options = {"mode": "FAILFAST"}
    if keep_broken:
        schema = T.StructType([*schema.fields, T.StructField(BROKEN_LINE, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN_LINE}
    if multi_line:
        options |= {"sep": sep, "escape": '"', "multiLine": "true"}
        records = scan_records(spark, path, names, sep)
        fields = F.from_csv("record", schema.simpleString(), options).alias("fields")
        rows = records.select(fields).select("fields.*")
    else:
        rows = _reader(spark, sep, False).option("enforceSchema", False).options(**options).schema(schema).csv(path)
    # Holds for every row, and needs all its columns.
    rows = rows.where(F.bit_count(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields])) >= 0)
    if not empty_as_text:
        return rows
    return rows.na.fill("", [f.name for f in schema.fields if f.name != BROKEN_LINE])


def _reader(spark: SparkSession, sep: str, multi_line: bool):
    return spark.read.option("sep", sep).option("header", True).option("escape", '"').option("multiLine", multi_line)


def scan_delimited_inferred(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """Read with inferred types and no NULLs: a missing value becomes its type's zero value.

    Integers are widened to long because ids outgrow 32 bits. Inference is an extra pass over the input: pass a
    schema to :func:`scan_delimited` for large files.
    """
    rows = (
        _reader(spark, sep, multi_line)
        .option("inferSchema", True)
        .option("mode", "FAILFAST")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(path)
    )
    return rows.select(*[_not_null(field).alias(field.name) for field in rows.schema.fields])


def _not_null(field: T.StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.IntegerType):
        column, zero = column.cast("bigint"), F.lit(0).cast("bigint")
    elif isinstance(field.dataType, T.NumericType):
        zero = F.lit(0).cast(field.dataType)
    elif isinstance(field.dataType, T.BooleanType):
        zero = F.lit(False)
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        column, zero = column.cast("timestamp_ntz"), F.lit("1970-01-01").cast("timestamp_ntz")
    elif isinstance(field.dataType, T.DateType):
        zero = F.lit("1970-01-01").cast("date")
    else:
        zero = F.lit("")
    return F.coalesce(column, zero)
