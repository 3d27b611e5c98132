"""Column functions: every one takes and returns Spark columns and stays in generated JVM code."""

from stockroom.functions.conditions import approx_unique, count_if, count_if_value, flag_is_set, text_is, unique
from stockroom.functions.messages import datetime_text, iso_record, message, message_text, parse_message
from stockroom.functions.timestamps import best_effort_timestamp, now, since_days, start_of_day, year_month

__all__ = [
    "approx_unique",
    "best_effort_timestamp",
    "count_if",
    "count_if_value",
    "datetime_text",
    "flag_is_set",
    "iso_record",
    "message",
    "message_text",
    "now",
    "parse_message",
    "since_days",
    "start_of_day",
    "text_is",
    "unique",
    "year_month",
]
