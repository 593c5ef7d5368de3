from tickloom.sources.files import list_documents, read_documents, read_lines, read_snapshots
from tickloom.sources.offsets import read_topic_day, refresh_index
from tickloom.sources.tables import partition_filter, read_days, read_optional, read_ticks
from tickloom.sources.topic import read_topic, topic_reader_options

__all__ = [
    "list_documents",
    "partition_filter",
    "read_days",
    "read_documents",
    "read_lines",
    "read_optional",
    "read_snapshots",
    "read_ticks",
    "read_topic",
    "read_topic_day",
    "refresh_index",
    "topic_reader_options",
]
