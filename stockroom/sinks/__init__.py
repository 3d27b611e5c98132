"""Tables and writes."""

from stockroom.sinks.partitions import drop_partitions, expire_months, replace_partitions, write_by_month
from stockroom.sinks.publish import publish
from stockroom.sinks.tables import (
    append_jdbc,
    append_rows,
    create_layers,
    create_table,
    create_table_as,
    insert_literals,
    sorted_for,
)

__all__ = [
    "append_jdbc",
    "append_rows",
    "create_layers",
    "create_table",
    "create_table_as",
    "drop_partitions",
    "expire_months",
    "insert_literals",
    "publish",
    "replace_partitions",
    "sorted_for",
    "write_by_month",
]
