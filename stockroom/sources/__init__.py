"""Sources: delimited files, tables and message topics."""

from stockroom.sources.files import scan_delimited, scan_delimited_inferred
from stockroom.sources.tables import scan_table
from stockroom.sources.topics import Topic, folder_topic, kafka_connection, kafka_topic, read_back

__all__ = [
    "Topic",
    "folder_topic",
    "kafka_connection",
    "kafka_topic",
    "read_back",
    "scan_delimited",
    "scan_delimited_inferred",
    "scan_table",
]
