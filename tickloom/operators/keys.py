"""Day and hour keys of instants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import civil_date, civil_time, epoch_seconds, plain_day


def partition_keys(df: DataFrame, zone: str, column: str = "ts") -> DataFrame:
    """Adds `dt`, `dt_nodash` and `hh` of a time in `zone`.

    A `timestamp_ntz` is a UTC time, a `timestamp` the instant it is; the session zone plays no part.
    """
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp_ntz":
        seconds = epoch_seconds(F.col(column))
    elif kind == "timestamp":
        seconds = F.unix_seconds(F.col(column))
    else:
        raise TypeError(f"{column} is a {kind}, not a time")
    timed = df.withColumn("_wall", civil_time(seconds, zone))
    day = civil_date(F.col("_wall"))
    return timed.select(
        *[F.col(name) for name in df.columns if name not in ("dt", "dt_nodash", "hh")],
        day.alias("dt"),
        plain_day(day).alias("dt_nodash"),
        F.lpad(F.hour("_wall").cast("string"), 2, "0").alias("hh"),
    )


def previous_day(day: Column) -> Column:
    return F.date_sub(day, 1)
