"""The list of check queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stockroom.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    """A query, the operators it exercises and SQL that gives the same result."""

    run: Query
    operators: tuple[str, ...]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(operators: str, sql: str | None) -> Callable[[Query], Query]:
    """Register the decorated query under its function name."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(spark, sf_dir)

        CHECKS[query.__name__] = Check(run, tuple(operators.split()), sql)
        return query

    return register


def covered_operators() -> Iterable[str]:
    return {operator for entry in CHECKS.values() for operator in entry.operators}


def fresh_database(spark: SparkSession) -> str:
    """A new database in the shared folder, for the tables a query writes."""
    name = f"stockroom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_dir(spark, name)}'")
    return name
