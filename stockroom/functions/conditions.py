"""Predicates and the aggregates built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_is(c: Column | str, text: str) -> Column:
    """Equal to a literal given as text. NULL is not a match.

    The literal takes the column's type, once and at planning time: ``'0'`` matches a raw text field, a numeric id and
    a flag, and the test can be pushed down to the scan.
    """
    return _column(c) == F.lit(text)


def flag_is_set(c: Column | str) -> Column:
    """A 0/1 field as a boolean; text that is no number gives NULL instead of an error."""
    return _column(c).try_cast("int") == F.lit(1)


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; an unknown condition does not count."""
    return F.count_if(condition)


def count_if_value(value: Column | str, condition: Column) -> Column:
    """Rows where the condition holds *and* ``value`` is not NULL."""
    return F.count(F.when(condition, _column(value)))


def unique(value: Column | str) -> Column:
    """Exact number of different non-NULL values."""
    return F.count_distinct(_column(value))


def approx_unique(value: Column | str, lg_k: int = 14) -> Column:
    """Estimated number of different non-NULL values, from one sketch of bounded size per group.

    The sketch starts small and its size is 2**lg_k at most; the standard error is about 1.04 / sqrt(2**lg_k), below
    one percent by default. Do not combine it with exact distinct counts in one aggregation: Spark would then keep a
    sketch per distinct value.
    """
    return F.hll_sketch_estimate(F.hll_sketch_agg(_column(value), lg_k))
