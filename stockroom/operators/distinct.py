"""Distinct counts whose state can be stored and combined later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap_state(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact state for dense integer ids: one bitmap of 4 KB per key and block of 32,768 ids.

    Tasks combine their bitmaps before the shuffle, and a hot key is split over its id blocks. For sparse ids keep the
    distinct (key, id) rows instead.
    """
    return (
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(value).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
    )


def bitmap_totals(state: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct count per key from any union of bitmap states."""
    blocks = state.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return blocks.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def sketch_state(rows: DataFrame, keys: Sequence[str], value: str, lg_k: int = 14) -> DataFrame:
    """Approximate state for ids of any kind: one sketch of bounded size per key."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def sketch_totals(state: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Estimated distinct count per key from any union of sketch states."""
    return state.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
