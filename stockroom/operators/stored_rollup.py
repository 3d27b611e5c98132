"""A time series that is stored, and thinned in its place as its points grow old.

The table holds cells: a metric's points of one step, combined. Cells merge: the largest value is the largest of the largest
ones, and "any" is the value with the smallest order. A cell is only as wide as every later step allows, so whatever is read
later is what :func:`age_rollup` would give from all points ever added.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockroom.operators.rollup import RollupRule, by_rule, step_at
from stockroom.session import work_dir
from stockroom.sinks.partitions import partition_values, replace_partitions
from stockroom.sinks.tables import create_table

DAY_SECONDS = 86_400
THINNED_TO = "stockroom.thinned_to"


@dataclass(frozen=True)
class ThinningReport:
    """The days that were rewritten, and their cells before and after."""

    days: int
    cells_read: int
    cells_kept: int


@dataclass(frozen=True)
class StoredRollup:
    """A stored series with its rules, partitioned by day.

    Adding points twice, or running a thinning again, changes nothing. One writer may work on the table at a time.
    """

    table: str
    rules: tuple[RollupRule, ...]

    def __post_init__(self):
        for rule in self.rules:
            for _, _, width in kept_steps(rule):
                if DAY_SECONDS % width:
                    raise ValueError(f"steps of {width} seconds do not fill a day")

    def create(self, spark: SparkSession, value: str = "DOUBLE", order: str = "BIGINT") -> StoredRollup:
        """The empty table, if it is missing, for values and orders of these SQL types."""
        columns = f"metric STRING, cell BIGINT, largest {value}, first_value {value}, first_order {order}, day DATE"
        create_table(spark, self.table, columns, partition_by=["day"], if_not_exists=True)
        return self

    def add(
        self,
        points: DataFrame,
        as_of: dt.datetime,
        metric: str = "metric",
        time: str = "ts",
        value: str = "value",
        order: str = "id",
    ) -> None:
        """Merge points into the days they belong to; late ones meet cells that are already thinned."""
        spark = points.sparkSession
        work_dir(spark)
        now = max(unix_second(as_of), self._thinned_to(spark) or 0)
        seconds = F.unix_seconds(F.col(time).cast("timestamp"))
        # The batch is read once: its days decide which partitions are read.
        cells = self._cells(
            points.select(
                F.col(metric).alias("metric"),
                seconds.alias("cell"),
                F.col(value).alias("largest"),
                F.col(value).alias("first_value"),
                F.col(order).alias("first_order"),
            ),
            now,
        ).checkpoint()
        days = [row["day"] for row in cells.select("day").distinct().collect()]
        self._replace(cells.unionByName(self._of_days(spark, days)), now)

    def thin(self, spark: SparkSession, as_of: dt.datetime) -> ThinningReport:
        """Combine the cells of which a whole wider cell has come of age since the last thinning.

        Only days in which a cell crosses a bound are read and rewritten.
        """
        now, since = unix_second(as_of), self._thinned_to(spark)
        if since is not None and now <= since:
            return ThinningReport(0, 0, 0)
        stored = {part["day"] for part in partition_values(spark, self.table)}
        crossed = [(first, last) for rule in self.rules for first, last in crossings(rule, since, now)]
        days = [
            day
            for day in (dt.date.fromisoformat(text) for text in stored if text[:1].isdigit())
            if any(first <= day_second(day) + DAY_SECONDS - 1 and day_second(day) <= last for first, last in crossed)
        ]
        report = ThinningReport(0, 0, 0)
        if days:
            work_dir(spark)
            read, kept = Observation(), Observation()
            cells = self._of_days(spark, days).observe(read, F.count("*").alias("cells"))
            self._replace(cells, now, kept)
            report = ThinningReport(len(days), read.get["cells"], kept.get["cells"])
        # Set last: a thinning that was lost is made up for by the next one.
        spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{THINNED_TO}' = '{now}')")
        return report

    def read(self, spark: SparkSession, as_of: dt.datetime) -> DataFrame:
        """The series (metric, bucket, value) at a time, as :func:`age_rollup` gives it from all points.

        The time has to be the last second of a step, and not before the last thinning; otherwise points on both sides of
        a bound share a cell.
        """
        now = unix_second(as_of)
        if now < (self._thinned_to(spark) or now):
            raise ValueError("the series has been thinned for a later time")
        for rule in self.rules:
            steps = kept_steps(rule)
            for (_, _, width), (bound, _, _) in zip(steps, steps[1:]):
                if (now + 1 - bound) % width:
                    raise ValueError(f"{as_of} is not the last second of a step of {width} seconds before age {bound}")
        age = F.lit(now) - F.col("cell")
        step = by_rule(self.rules, "metric", lambda rule: step_at(rule, age))
        function = by_rule(self.rules, "metric", lambda rule: F.lit(rule.function))
        placed = spark.table(self.table).withColumns(
            {"bucket": F.col("cell") - F.pmod("cell", step), "function": function}
        )
        steps = placed.groupBy("metric", "bucket", "function").agg(
            F.max("largest").alias("largest"), F.min_by("first_value", "first_order").alias("first")
        )
        combined = F.when(F.col("function") == "any", F.col("first")).otherwise(F.col("largest"))
        return steps.select("metric", "bucket", combined.alias("value"))

    def _cells(self, rows: DataFrame, now: int) -> DataFrame:
        """Points or cells put together into the cells they have at this second; combined before the shuffle."""

        def width(rule: RollupRule) -> Column:
            wide_first = [
                F.when(F.col("cell") < end_of_age(bound, width, now), F.lit(width))
                for bound, _, width in reversed(kept_steps(rule)[1:])
            ]
            return F.coalesce(*wide_first, F.lit(kept_steps(rule)[0][2]))

        cell = F.col("cell") - F.pmod("cell", by_rule(self.rules, "metric", width))
        return (
            rows.select("metric", cell.alias("cell"), "largest", "first_value", "first_order")
            .groupBy("metric", "cell")
            .agg(
                F.max("largest").alias("largest"),
                F.min_by("first_value", "first_order").alias("first_value"),
                F.min("first_order").alias("first_order"),
            )
            .withColumn("day", F.timestamp_seconds("cell").cast("date"))
        )

    def _of_days(self, spark: SparkSession, days: Sequence[dt.date | None]) -> DataFrame:
        known = [F.lit(day) for day in days if day is not None]
        wanted = F.col("day").isin(known) if known else F.lit(False)
        return spark.table(self.table).where(wanted | F.col("day").isNull() if None in days else wanted)

    def _replace(self, cells: DataFrame, now: int, seen: Observation | None = None) -> None:
        # Written to the shared folder first, as these days are read from where they are written to.
        merged = self._cells(cells, now).checkpoint()
        replace_partitions(merged.observe(seen, F.count("*").alias("cells")) if seen else merged, self.table)

    def _thinned_to(self, spark: SparkSession) -> int | None:
        rows = spark.sql(f"SHOW TBLPROPERTIES {self.table}").where(F.col("key") == THINNED_TO).collect()
        return int(rows[0]["value"]) if rows else None


def kept_steps(rule: RollupRule) -> list[tuple[int, int, int]]:
    """(age, step to read, step to keep) by age: what is kept has to fit into the steps of this and of every later age."""
    youngest_first = sorted(rule.retention)
    widths = [width for _, width in youngest_first]
    return [(age, width, math.gcd(*widths[at:])) for at, (age, width) in enumerate(youngest_first)]


def end_of_age(bound: int, width: int, now: int) -> int:
    """The second before which whole cells of this width are of the age."""
    return (now - bound + 1) // width * width


def crossings(rule: RollupRule, since: int | None, now: int) -> Iterator[tuple[float, int]]:
    """Seconds (first, last) whose cells have become wider since the last time."""
    steps = kept_steps(rule)
    for (_, _, before), (bound, _, width) in zip(steps, steps[1:]):
        first = -math.inf if since is None else end_of_age(bound, width, since)
        last = end_of_age(bound, width, now) - 1
        if before != width and first <= last:
            yield first, last


def unix_second(time: dt.datetime) -> int:
    """Times carry no zone; their seconds are counted as in the session's zone, UTC."""
    return math.floor(time.replace(tzinfo=time.tzinfo or dt.timezone.utc).timestamp())


def day_second(day: dt.date) -> int:
    return unix_second(dt.datetime.combine(day, dt.time()))
