"""Insert-or-update with a freshness guard on a date-partitioned table."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import astuple, dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import work_dir
from stockroom.sinks.partitions import replace_partitions

# The column that tells batches of rejected rows apart.
BATCH_KEY = "batch_key"


@dataclass(frozen=True)
class UpsertReport:
    """What became of the rows that arrived: the rest of ``received`` were the newest of their keys and were inserted,
    updated a stored row, were equal to it, or were stale."""

    received: int
    without_key: int
    superseded: int
    inserted: int
    updated: int
    unchanged: int
    stale: int

    @property
    def applied(self) -> int:
        return self.inserted + self.updated

    @classmethod
    def total(cls, reports: Iterable[UpsertReport]) -> UpsertReport:
        """Several upserts as one."""
        return cls(*map(sum, zip((0,) * 7, *map(astuple, reports), strict=True)))


def has_whole_key(keys: Sequence[str]) -> Column:
    """True for rows without a NULL in their key. The negation selects the rows an upsert leaves out."""
    return reduce(and_, [F.col(key).isNotNull() for key in keys])


def newest_per_key(rows: DataFrame, keys: Sequence[str], load_time: str) -> DataFrame:
    """One row per key: the latest load time, ties broken by the other columns' order.

    A maximum instead of a ranking window: copies of a hot key combine before the shuffle.
    """
    values = [c for c in rows.columns if c not in keys and c != load_time]
    newest = F.max(F.struct(load_time, *values)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*rows.columns)


def guarded_merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], load_time: str) -> DataFrame:
    """Existing rows, replaced or joined by incoming ones; both sides have unique, non-NULL keys.

    An incoming row replaces the existing one only if ``existing.load_time <= incoming.load_time``; an unknown time on
    either side keeps the existing row. Presence is marked explicitly, so NULL values cannot be mistaken for absence.
    """
    return merged_with_outcome(existing, incoming, keys, load_time).drop("outcome")


def merged_with_outcome(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], load_time: str) -> DataFrame:
    """:func:`guarded_merge` with what happened to each row: kept, inserted, updated, unchanged or stale."""
    values = [c for c in existing.columns if c not in keys]
    before = existing.select(*keys, F.struct(*values).alias("before"), F.lit(True).alias("is_stored"))
    after = incoming.select(*keys, F.struct(*values).alias("after"), F.lit(True).alias("has_arrived"))
    fresh = F.coalesce(F.col(f"before.{load_time}") <= F.col(f"after.{load_time}"), F.lit(False))
    outcome = (
        F.when(F.col("has_arrived").isNull(), "kept")
        .when(F.col("is_stored").isNull(), "inserted")
        .when(F.col("before").eqNullSafe(F.col("after")), "unchanged")
        .when(fresh, "updated")
        .otherwise("stale")
    )
    replaces = F.col("outcome").isin("inserted", "updated")
    return (
        before.join(after, list(keys), "full_outer")
        .withColumn("outcome", outcome)
        .select(*keys, F.when(replaces, F.col("after")).otherwise(F.col("before")).alias("row"), "outcome")
        .select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in existing.columns], "outcome")
    )


def as_stored(column: str, sql_type: str) -> Column:
    """The column as the table holds it; fixed-length text is padded, so that it matches stored keys."""
    fixed = re.fullmatch(r"char\((\d+)\)", sql_type)
    if not fixed:
        return F.col(column).cast(sql_type)
    text, width = F.col(column).cast("string"), int(fixed[1])
    too_long = F.raise_error(F.concat(F.lit(f"EXCEED_LIMIT_LENGTH: more than {width} characters: "), text))
    return (
        F.when(F.length(text) < width, F.rpad(text, width, " "))
        .when(F.length(F.rtrim(text)) > width, too_long)
        .otherwise(F.substring(text, 1, width))
    )


def guarded_upsert(
    spark: SparkSession,
    incoming: DataFrame,
    table: str,
    keys: Sequence[str] = ("dt_date", "state_id"),
    load_time: str = "dt_load",
    partition: str = "dt_date",
    rejected: str | None = None,
) -> UpsertReport:
    """Merge ``incoming`` into the table partitioned by ``partition``, which must be one of the keys.

    Reads the stored dates between the first and the last that arrived, and rewrites only dates in which a row really
    changes. Rows with a NULL key match nothing and have no date to be stored under: they are counted, and with
    ``rejected`` kept in that table (see :func:`rejected_columns`), where a batch that is sent again replaces itself. Of
    several rows with one key the newest is used. One writer at a time; a reader that is scanning a date while it is
    replaced has to repeat its query.
    """
    keys = list(keys)
    if partition not in keys:
        raise ValueError(f"{partition} has to be one of the keys, or a row could be stored under two of its values")
    work_dir(spark)
    target = spark.table(table)
    types = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE {table}").collect()}
    has_key = has_whole_key(keys)
    # Written once: everything below reads the same batch, whatever is run again.
    batch = incoming.select(*[as_stored(c, types[c]).alias(c) for c in target.columns]).checkpoint()
    arrived = batch.agg(F.count("*").alias("received"), F.count_if(~has_key).alias("without_key")).first()
    if rejected and arrived["without_key"]:
        refused = batch.where(~has_key)
        content = refused.agg(F.bit_xor(F.xxhash64(*refused.columns)), F.sum(F.hash(*refused.columns)), F.count("*"))
        key = "-".join(str(part) for part in content.first())
        replace_partitions(refused.withColumn(BATCH_KEY, F.lit(key)), rejected)

    newest = newest_per_key(batch.where(has_key), keys, load_time).checkpoint()
    first, last = newest.agg(F.min(partition), F.max(partition)).first()
    # The bounds are literals, which prune partitions at planning time; the dates between them that did not arrive go.
    near = target.where(F.col(partition).between(F.lit(first), F.lit(last)))
    touched = near.join(newest.select(partition).distinct(), partition, "left_semi").select(*target.columns)
    merged = merged_with_outcome(touched, newest, keys, load_time).checkpoint()
    outcomes = {row["outcome"]: row["count"] for row in merged.groupBy("outcome").count().collect()}
    counts = [outcomes.get(name, 0) for name in ("inserted", "updated", "unchanged", "stale")]
    if counts[0] + counts[1]:
        changed = merged.where(F.col("outcome").isin("inserted", "updated")).select(partition).distinct()
        rewritten = merged.join(changed, partition, "left_semi").select(*target.columns)
        # Rebalancing gathers a date's rows into few files and lets Spark split a date that is too large for one task.
        replace_partitions(rewritten.hint("rebalance", partition), table)
    superseded = arrived["received"] - arrived["without_key"] - sum(counts)
    return UpsertReport(arrived["received"], arrived["without_key"], superseded, *counts)


def rejected_columns(columns: str) -> str:
    """The column list of a table of rejected rows, to be partitioned by ``batch_key``."""
    return f"{columns}, {BATCH_KEY} STRING"
