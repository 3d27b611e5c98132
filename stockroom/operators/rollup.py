"""Age-based thinning of time series: older points go into coarser (or finer) time steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RollupRule:
    """For series whose name matches: how to combine a step's points, and (age, step) pairs in seconds."""

    pattern: str
    function: str
    retention: tuple[tuple[int, int], ...]

    def __post_init__(self):
        if self.function not in ("any", "max"):
            raise ValueError(f"unknown rollup function {self.function!r}")
        if not any(age == 0 for age, _ in self.retention):
            raise ValueError("a rule needs a step for age 0")


def step_at(rule: RollupRule, age: Column) -> Column:
    """The step, in seconds, of a point of this age; a point of the future has that of age 0."""
    oldest_first = sorted(rule.retention, reverse=True)
    widths = [F.when(age >= bound, F.lit(width)) for bound, width in oldest_first]
    return F.coalesce(*widths, F.lit(oldest_first[-1][1]))


def by_rule(rules: Sequence[RollupRule], metric: str, choose: Callable[[RollupRule], Column]) -> Column:
    """What the first rule says that fits the metric's name."""
    return F.coalesce(*[F.when(F.col(metric).rlike(rule.pattern), choose(rule)) for rule in rules])


def age_rollup(
    points: DataFrame,
    rules: Sequence[RollupRule],
    as_of: Column,
    metric: str = "metric",
    time: str = "ts",
    value: str = "value",
    order: str = "id",
) -> DataFrame:
    """One row (metric, bucket, value) per series and time step; ``bucket`` is the step's first unix second.

    The first rule whose pattern is found in the metric's name applies. ``any`` takes the value with the smallest
    ``order``, so that a rerun gives the same result. Both functions combine before the shuffle.
    """
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    age = F.unix_seconds(as_of.cast("timestamp")) - seconds
    step = by_rule(rules, metric, lambda rule: step_at(rule, age))
    placed = points.select(
        F.col(metric).alias("metric"),
        (seconds - F.pmod(seconds, step)).alias("bucket"),
        by_rule(rules, metric, lambda rule: F.lit(rule.function)).alias("function"),
        F.col(value).alias("value"),
        F.col(order).alias("order"),
    )
    steps = placed.groupBy("metric", "bucket", "function").agg(
        F.max("value").alias("largest"), F.min_by("value", "order").alias("first")
    )
    combined = F.when(F.col("function") == "any", F.col("first")).otherwise(F.col("largest"))
    return steps.select("metric", "bucket", combined.alias("value"))
