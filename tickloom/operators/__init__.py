from tickloom.operators.flat import decode_flat
from tickloom.operators.keys import partition_keys, previous_day
from tickloom.operators.sets import dedupe_exact, partition_counts, union_prior
from tickloom.operators.snapshots import (
    accepted,
    decode_envelope,
    explode_snapshot,
    rejected,
    status_filter,
)
from tickloom.operators.ticks import (
    day_range,
    day_slice,
    normalize_ticks,
    with_civil_day,
    with_civil_time,
)

__all__ = [
    "accepted",
    "day_range",
    "day_slice",
    "decode_envelope",
    "decode_flat",
    "dedupe_exact",
    "explode_snapshot",
    "normalize_ticks",
    "partition_counts",
    "partition_keys",
    "previous_day",
    "rejected",
    "status_filter",
    "union_prior",
    "with_civil_day",
    "with_civil_time",
]
