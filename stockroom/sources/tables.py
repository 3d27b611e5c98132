"""Stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All rows, with the given columns in the given order (default: the table's own)."""
    rows = spark.table(table)
    return rows.select(*columns) if columns else rows
