"""Scans of the day-partitioned parquet tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.days import as_date
from tickloom.operators.ticks import day_range, day_slice
from tickloom.schemas import BATCH
from tickloom.sources.paths import (
    MAX_LISTED_DAYS,
    days_glob,
    is_missing_path,
    no_rows,
    scan,
)


def read_ticks(spark: SparkSession, root: str, schema: StructType = BATCH) -> DataFrame:
    """The whole table with its declared schema."""
    return scan(spark, "parquet", schema, root)


def partition_filter(
    df: DataFrame, day: dt.date | str, until: dt.date | str | None = None
) -> DataFrame:
    """One day, or the days from `day` up to `until`, as a predicate on `dt`."""
    return day_slice(df, day) if until is None else day_range(df, day, until)


def read_optional(
    spark: SparkSession, root: str, schema: StructType = BATCH, path: str | None = None
) -> DataFrame:
    """The table (or one path in it), or no rows where the path does not exist.

    Every other error is raised: bad credentials or a schema clash must not look
    like an empty table.
    """
    try:
        return scan(spark, "parquet", schema, root, path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return no_rows(spark, schema)


def read_days(
    spark: SparkSession, root: str, days: Sequence[dt.date | str], schema: StructType = BATCH
) -> DataFrame:
    """The stored rows of `days`; days without a partition give none.

    Lists only the directories of those days, unless they are too many to name.
    """
    wanted = sorted({as_date(day) for day in days})
    if not wanted:
        return no_rows(spark, schema)
    path = days_glob(root, wanted) if len(wanted) <= MAX_LISTED_DAYS else None
    stored = read_optional(spark, root, schema, path)
    return stored.where(F.col("dt").isin([F.lit(day) for day in wanted]))


def scan_bytes(stored: DataFrame) -> int:
    """The size of the files that a scan of stored days reads, by their listing."""
    return int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
