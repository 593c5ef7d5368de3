from tickloom.sinks.days import append_days, append_once, overwrite_days, replace_day
from tickloom.sinks.documents import compact_small_files
from tickloom.sinks.merge import MergeReport, merge_partitions

__all__ = [
    "MergeReport",
    "append_days",
    "append_once",
    "compact_small_files",
    "merge_partitions",
    "overwrite_days",
    "replace_day",
]
