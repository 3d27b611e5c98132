"""Operators: each takes a DataFrame and returns one, and can be used with ``DataFrame.transform``."""

from stockroom.operators.daily_report import daily_report
from stockroom.operators.distinct import (
    bitmap_state,
    bitmap_totals,
    sketch_state,
    sketch_totals,
)
from stockroom.operators.identifiers import IdDictionary
from stockroom.operators.items import (
    blank_missing_tare_type,
    lost_values,
    parse_items,
    parse_with_quarantine,
    typed_items,
)
from stockroom.operators.records import expand_records, record_arrays
from stockroom.operators.rollup import RollupRule, age_rollup
from stockroom.operators.stored_rollup import StoredRollup, ThinningReport
from stockroom.operators.totals import office_totals, state_counts
from stockroom.operators.upsert import UpsertReport, guarded_merge, guarded_upsert
from stockroom.operators.variants import loose_records, observed_fields, typed_records

__all__ = [
    "IdDictionary",
    "RollupRule",
    "StoredRollup",
    "ThinningReport",
    "UpsertReport",
    "age_rollup",
    "bitmap_state",
    "bitmap_totals",
    "blank_missing_tare_type",
    "daily_report",
    "expand_records",
    "guarded_merge",
    "guarded_upsert",
    "loose_records",
    "lost_values",
    "observed_fields",
    "office_totals",
    "parse_items",
    "parse_with_quarantine",
    "record_arrays",
    "sketch_state",
    "sketch_totals",
    "state_counts",
    "typed_items",
    "typed_records",
]
