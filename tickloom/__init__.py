"""Market-tick ingestion on Spark: snapshots and topic messages to day-partitioned tables."""

from tickloom.operators import (
    accepted,
    day_range,
    day_slice,
    decode_envelope,
    decode_flat,
    dedupe_exact,
    explode_snapshot,
    normalize_ticks,
    partition_counts,
    partition_keys,
    previous_day,
    rejected,
    status_filter,
    union_prior,
    with_civil_day,
    with_civil_time,
)
from tickloom.plans.jobs import daily_load, daily_load_indexed, hourly_batch, land_hour
from tickloom.sinks import (
    append_days,
    append_once,
    compact_small_files,
    merge_partitions,
    overwrite_days,
    replace_day,
)
from tickloom.sources import (
    partition_filter,
    read_days,
    read_documents,
    read_optional,
    read_snapshots,
    read_ticks,
    read_topic,
    read_topic_day,
    refresh_index,
)

__all__ = [
    "accepted",
    "append_days",
    "append_once",
    "compact_small_files",
    "daily_load",
    "daily_load_indexed",
    "day_range",
    "day_slice",
    "decode_envelope",
    "decode_flat",
    "dedupe_exact",
    "explode_snapshot",
    "hourly_batch",
    "land_hour",
    "merge_partitions",
    "normalize_ticks",
    "overwrite_days",
    "partition_counts",
    "partition_filter",
    "partition_keys",
    "previous_day",
    "read_days",
    "read_documents",
    "read_optional",
    "read_snapshots",
    "read_ticks",
    "read_topic",
    "read_topic_day",
    "refresh_index",
    "rejected",
    "replace_day",
    "status_filter",
    "union_prior",
    "with_civil_day",
    "with_civil_time",
]
