"""Structured Streaming jobs: replay-safe loading and incremental state."""

from stockroom.streaming.accounts import accounts, counted, create_accounts, keep_account
from stockroom.streaming.admission import Admission
from stockroom.streaming.daily import DailyReportState, keep_daily_report
from stockroom.streaming.loading import batch_table_columns, for_each_batch, load_into
from stockroom.streaming.state import BatchedRows, MergeableState, compact_now_and_then
from stockroom.streaming.totals import (
    add_office_totals,
    keep_office_totals,
    latest_totals,
    office_state,
    running_office_totals,
)

__all__ = [
    "accounts",
    "counted",
    "create_accounts",
    "keep_account",
    "Admission",
    "BatchedRows",
    "DailyReportState",
    "MergeableState",
    "add_office_totals",
    "batch_table_columns",
    "compact_now_and_then",
    "for_each_batch",
    "keep_daily_report",
    "keep_office_totals",
    "latest_totals",
    "load_into",
    "office_state",
    "running_office_totals",
]
