"""Writes of day-partitioned parquet tables. One writer per table at a time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tickloom.days import as_date
from tickloom.operators.ticks import day_slice
from tickloom.scratch import staged
from tickloom.sinks.changes import change_days, finish
from tickloom.sinks.layout import packed, spread
from tickloom.sources.tables import read_days


def write_dynamic(df: DataFrame, path: str, *keys: str, fmt: str = "parquet") -> None:
    """Replaces the partitions that occur in `df`, with its rows where they are."""
    # The mode is set on the write: a session without the setting would
    # otherwise drop the whole table.
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .format(fmt)
        .save(path)
    )


def overwrite_days(df: DataFrame, path: str) -> None:
    """Replaces the days that occur in `df`, and no others.

    The new files are staged and swapped in at the end, so `df` may read the
    table it replaces.
    """
    write_dynamic(spread(df, "dt"), path, "dt")


def append_days(df: DataFrame, path: str, files: int | None = None) -> None:
    """Appends `df`, day-partitioned. A second run doubles the rows; see `replace_day`.

    `files` sets the number of write tasks, and so the most files per day.
    """
    rows = spread(df, "dt") if files is None else df.repartition(files)
    rows.write.mode("append").partitionBy("dt").parquet(path)


def append_once(df: DataFrame, path: str, load: str, note: dict | None = None, files: int | None = None) -> bool:
    """Appends `df` as the load of that name; false, and nothing added, if the table has had it.

    The ledger of the table decides, not the rows: copies within a load, or of two loads, all stay. `note`
    is kept there.
    """
    rows = spread(df, "dt") if files is None else df.repartition(files)
    return change_days(rows, path, change=load, note=note)


def replace_day(
    df: DataFrame,
    path: str,
    day: dt.date | str,
    files: int | None = None,
    stage: bool = True,
    shrink: bool = False,
) -> int:
    """Makes `df`'s rows of `day` the whole content of that day; gives their number.

    Safe to repeat. A day is not left with fewer rows than it has, or empty, unless `shrink` says
    so: a source may have forgotten some of them. The slice is staged, so that file footers give
    its number of rows and the final write needs no shuffle. Pass `stage=False` for a plain table
    scan.
    """
    day = as_date(day)
    rows = day_slice(df, day)
    if not stage:
        return _replace(rows, path, day, files, shrink)
    with staged(rows, "day") as slice_:
        return _replace(slice_, path, day, files, shrink)


def _replace(rows: DataFrame, path: str, day: dt.date, files: int | None, shrink: bool) -> int:
    count = rows.count()
    finish(rows.sparkSession, path)
    if not shrink:
        stored = read_days(rows.sparkSession, path, [day], rows.schema).count()
        if count < stored:
            raise ValueError(f"{day} holds {stored} rows and would keep {count}; see shrink")
    tasks = packed(rows, count) if files is None else rows.repartition(files)
    change_days(tasks, path, [f"dt={day}"])
    return count
