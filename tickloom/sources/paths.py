"""Scans of chosen partition directories.

A plain scan of a table root lists every directory below it before a filter
prunes anything. With years of hourly directories that listing is the job, so
scans of a few days name their directories in one glob instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Longest list of days that is written into a glob or an IN list. A longer one
# names all day directories, and a filter drops the other days: the same files
# are read either way.
MAX_LISTED_DAYS = 1000


def days_between(first: dt.date, stop: dt.date) -> list[dt.date] | None:
    """The days from `first` up to `stop`, or None if they are too many to list."""
    count = (stop - first).days
    if count > MAX_LISTED_DAYS:
        return None
    return [first + dt.timedelta(days=i) for i in range(max(count, 0))]


def days_glob(
    root: str, days: Sequence[dt.date] | None, plain: bool = False, below: str = ""
) -> str:
    """One path for the directories of `days`, or of all days for None.

    Day directories lie directly below the root. `plain` adds the `yyyyMMdd` form.
    """
    if days is None:
        return f"{root.rstrip('/')}/dt=*{below}"
    names = [day.isoformat() for day in days]
    if plain:
        names += [day.strftime("%Y%m%d") for day in days]
    return f"{root.rstrip('/')}/dt={{{','.join(names)}}}{below}"


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty."""
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(0).select(*nulls)


def scan(
    spark: SparkSession,
    fmt: str,
    schema: StructType | str,
    root: str,
    path: str | list[str] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    reader = spark.read.format(fmt).schema(schema).option("basePath", root)
    return reader.options(**(options or {})).load(path or root)
