from tickloom.functions.civil import (
    civil_date,
    civil_text,
    civil_time,
    dashed_day,
    day_seconds,
    epoch_millis,
    epoch_seconds,
    in_calendar,
    plain_day,
    seconds_from_millis,
    seconds_from_prefix,
)
from tickloom.functions.text import last_wins, strip_blanks, to_double, whole_number

__all__ = [
    "civil_date",
    "civil_text",
    "civil_time",
    "dashed_day",
    "day_seconds",
    "epoch_millis",
    "epoch_seconds",
    "in_calendar",
    "last_wins",
    "plain_day",
    "seconds_from_millis",
    "seconds_from_prefix",
    "strip_blanks",
    "to_double",
    "whole_number",
]
