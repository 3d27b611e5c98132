"""Warehouse-inventory analytics on Spark DataFrames and Structured Streaming."""

from stockroom.session import build_session, fresh_dir, work_dir

__all__ = ["build_session", "fresh_dir", "work_dir"]
