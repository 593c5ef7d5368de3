"""Typed tick rows in the column order of the two tables, and slices by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.days import as_date
from tickloom.functions import (
    civil_date,
    civil_text,
    civil_time,
    day_seconds,
    in_calendar,
    seconds_from_millis,
    seconds_from_prefix,
    to_double,
    whole_number,
)
from tickloom.schemas import BATCH_MEASURES, TIME_KEY, WAREHOUSE_MEASURES


# Civil time of a row, where it has been worked out already.
CIVIL = ("civil_text", "civil_day")


def with_civil_time(df: DataFrame, zone: str, layout: str = "batch") -> DataFrame:
    """Adds the civil time of the row's epoch in `zone`, as text and as a day.

    `batch` reads the epoch milliseconds in `timestamp`, `warehouse` those in
    `date`.
    """
    timed = df.withColumn("_seconds", _seconds(layout))
    timed = timed.withColumn("_wall", civil_time(F.col("_seconds"), zone))
    text, day = CIVIL
    return timed.select(
        *df.columns,
        civil_text(F.col("_wall")).alias(text),
        civil_date(F.col("_wall")).alias(day),
    )


def _seconds(layout: str) -> Column:
    if layout == "batch":
        return seconds_from_millis(F.col("timestamp"))
    return whole_number(seconds_from_prefix(F.col(TIME_KEY)))


def with_civil_day(
    df: DataFrame, day: dt.date | str, zone: str, layout: str = "batch", timeless: bool = False
) -> DataFrame:
    """The rows of one civil day, with their civil time; with `timeless` also those without a usable time.

    Rows are told by their epoch seconds, against the two instants between which the day lies, so no zone
    is looked up for rows of other days, and once for each of this one.
    """
    day = as_date(day)
    start, stop, exact = day_seconds(day, zone)
    text, day_name = CIVIL
    seconds = F.col("_seconds")
    inside = (seconds >= start) & (seconds < stop)
    timed = df.withColumn("_seconds", in_calendar(_seconds(layout)))
    timed = timed.where(inside | seconds.isNull()) if timeless else timed.where(inside)
    wall = civil_time(seconds, zone)
    civil_day = F.when(inside, F.lit(day)) if exact else civil_date(wall)
    rows = timed.select(*df.columns, civil_text(wall).alias(text), civil_day.alias(day_name))
    if exact:
        return rows
    kept = F.col(day_name) == F.lit(day)
    return rows.where(kept | F.col(day_name).isNull()) if timeless else rows.where(kept)


def normalize_ticks(
    df: DataFrame, zone: str, layout: str = "batch", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Text fields to a typed row with its civil time and `dt` in `zone`.

    Rows of one snapshot share its time, so `with_civil_time` may be applied
    before the snapshot is exploded; otherwise it is applied here. `keep` names
    further columns to carry along.
    """
    text, day = CIVIL
    if layout == "batch":
        texts = [F.col("coin"), F.col(text).alias("timestamp")]
        measures = BATCH_MEASURES
    elif layout == "warehouse":
        prefix = seconds_from_prefix(F.col(TIME_KEY))
        texts = [F.col("coin"), F.col(text).alias("date"), prefix.alias("timestamp")]
        measures = WAREHOUSE_MEASURES
    else:
        raise ValueError(f"unknown layout: {layout}")
    timed = df if set(CIVIL) <= set(df.columns) else with_civil_time(df, zone, layout)
    return timed.select(
        *texts,
        *[to_double(F.col(name)).alias(name) for name in measures],
        F.col(day).alias("dt"),
        *keep,
    )


def day_slice(df: DataFrame, day: dt.date | str, column: str = "dt") -> DataFrame:
    """Rows of one civil day."""
    return df.where(F.col(column) == F.lit(as_date(day)))


def day_range(
    df: DataFrame, day: dt.date | str, until: dt.date | str, column: str = "dt"
) -> DataFrame:
    """Rows of the days from `day` up to, but not including, `until`."""
    first, stop = F.lit(as_date(day)), F.lit(as_date(until))
    return df.where((F.col(column) >= first) & (F.col(column) < stop))
