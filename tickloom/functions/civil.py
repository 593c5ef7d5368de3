"""Epoch and civil time as native expressions.

The zone is always an argument. Nothing here reads the session time zone: wall
clock values are `timestamp_ntz`, and they become text or dates by a plain cast.
`date_format`, `timestampdiff` and `from_unixtime` pass through the session zone
(the first two shift an hour inside its DST gaps), so none of them is used.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of 0001-01-02 and 9999-12-30: a day inside the calendar Spark can
# print, so that no zone offset leaves it. A wilder epoch reads as null instead
# of failing the job with an overflow.
MIN_SECONDS = -62135510400
MAX_SECONDS = 253402214400


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def in_calendar(seconds: Column) -> Column:
    """Seconds that are a civil time, null otherwise."""
    return F.when(seconds.between(MIN_SECONDS, MAX_SECONDS), seconds)


def epoch_millis(ts: Column) -> Column:
    """Whole milliseconds (bigint) of a UTC `timestamp_ntz`, rounded down."""
    seconds = (ts - _epoch()).cast("interval second").cast("decimal(20,6)")
    return F.floor(seconds * 1000).cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds (bigint) of a UTC `timestamp_ntz`, rounded down."""
    return F.floor((ts - _epoch()).cast("interval second").cast("decimal(20,6)")).cast("bigint")


def seconds_from_millis(ms: Column) -> Column:
    """Epoch milliseconds (text or number) to whole seconds; null if not an epoch.

    Digits take the integer path; `1.636E12` and the like go through double.
    """
    whole = F.call_function("div", ms.try_cast("bigint"), F.lit(1000).cast("bigint"))
    fractional = (ms.try_cast("double") / F.lit(1000.0)).try_cast("bigint")
    return F.coalesce(whole, fractional)


def seconds_from_prefix(epoch: Column) -> Column:
    """The first ten characters of an epoch text: its seconds, still as text."""
    return F.substring(epoch, 1, 10)


def civil_time(seconds: Column, zone: str) -> Column:
    """Wall clock (`timestamp_ntz`) of epoch seconds in `zone`.

    The instant is shifted by the zone's offset and read back as seconds, which
    leaves the session zone out. `convert_timezone` gives the same at four times
    the cost, since it looks the zone up for every row.
    """
    instant = F.timestamp_seconds(in_calendar(seconds))
    shifted = F.unix_seconds(F.from_utc_timestamp(instant, F.lit(zone)))
    return F.timestamp_add("SECOND", shifted, _epoch())


def day_seconds(day: dt.date, zone: str) -> tuple[int, int, bool]:
    """The epoch seconds from which and up to which a civil day lies, and whether nothing else lies there.

    A day that begins twice, since clocks go back over its midnight, shares its span with the day before.
    """
    there = ZoneInfo(zone)
    first = dt.datetime.combine(day, dt.time(), there)
    last = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(fold=1), there)
    start, stop = (int(at.timestamp()) for at in (first, last))
    around = range(start - 2 * 3600, stop + 2 * 3600, 60)
    exact = all(
        (dt.datetime.fromtimestamp(at, there).date() == day) == (start <= at < stop) for at in around
    )
    return start, stop, exact


def civil_text(wall: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` of a whole-second wall clock."""
    return wall.cast("string")


def civil_date(wall: Column) -> Column:
    return wall.cast("date")


def dashed_day(day: Column) -> Column:
    """`20210513` or `2021-05-13` as a date; null for anything else."""
    return F.regexp_replace(day, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date")


def plain_day(day: Column) -> Column:
    """A date as `yyyyMMdd`."""
    return F.translate(day.cast("string"), "-", "")
