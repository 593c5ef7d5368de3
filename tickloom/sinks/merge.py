"""Merge of new rows into the days they touch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.operators.membership import may_be_in
from tickloom.operators.sets import dedupe_exact, union_prior
from tickloom.scratch import observed
from tickloom.schemas import BATCH
from tickloom.sinks.changes import change_days, finish
from tickloom.sinks.days import append_days
from tickloom.sinks.layout import TASK_ROWS, packed, spread, widened
from tickloom.sources.paths import MAX_LISTED_DAYS
from tickloom.sources.tables import read_days, read_optional, scan_bytes

# Up to this many days the dedupe's own tasks are written as they are, joined to
# a good size. Each holds rows of every day, so it writes at most this many
# files, and a second shuffle of all rows is saved.
FEW_DAYS = 8

# Stored rows of an appending merge are counted by the size of their files, not by a job: this or more
# bytes a row. A wider shuffle than needed costs little, since adaptive execution joins its tasks.
STORED_ROW_BYTES = 24

# From this size of stored files on, a filter of the new rows is built before the stored ones are shuffled.
FILTER_BYTES = 64 << 20

# The column by which stored rows are narrowed before an appending merge.
CLOCK = "timestamp"


@dataclass(frozen=True)
class MergeReport:
    """The touched days. There are no more of them than the calendar has."""

    days: tuple[dt.date, ...]

    @property
    def day_count(self) -> int:
        return len(self.days)


@dataclass(frozen=True)
class Touched:
    """What a merge has to know of its new rows: days, number, first and last time, and rows without a day."""

    days: tuple[dt.date, ...]
    rows: int
    first: object = None
    last: object = None
    dayless: int = 0


def measures(clock: str | None, dt: Column | str = "dt", when: Column | None = None, prefix: str = "") -> list[Column]:
    """The aggregates of `Touched`, over the rows that meet `when`; for `observe` or `agg`."""
    when = F.lit(True) if when is None else when
    day = F.col(dt) if isinstance(dt, str) else dt
    time = F.when(when, F.col(clock)) if clock else F.lit(None)
    return [
        F.count(F.when(when, 1)).alias(f"{prefix}rows"),
        F.count(F.when(when & day.isNull(), 1)).alias(f"{prefix}dayless"),
        F.collect_set(F.when(when, day)).alias(f"{prefix}days"),
        F.min(time).alias(f"{prefix}first"),
        F.max(time).alias(f"{prefix}last"),
    ]


def touched(found: Mapping[str, object], prefix: str = "") -> Touched:
    """`Touched` from the values of `measures`. Nothing was observed where there was nothing to write."""
    days = tuple(sorted(found.get(f"{prefix}days") or ()))
    rows, dayless = (found.get(f"{prefix}{name}") or 0 for name in ("rows", "dayless"))
    return Touched(days, rows, found.get(f"{prefix}first"), found.get(f"{prefix}last"), dayless)


def merge_partitions(
    new: DataFrame,
    path: str,
    schema: StructType = BATCH,
    stage: bool = True,
    task_rows: int = TASK_ROWS,
    rewrite: bool = True,
    key: Sequence[str] | None = None,
    clock: str = CLOCK,
    seen: Touched | None = None,
) -> MergeReport:
    """Adds `new` to the stored rows of every day it touches, without copies.

    Stored rows are never lost, a second run changes nothing, and untouched days
    are neither read nor written. Rows need a `dt`: without one they would be
    dropped by the next merge, so they are refused.

    With `rewrite` the touched days are replaced as a whole, which also removes
    copies they already held. Without it only the rows they lack are appended:
    the cost then follows the new rows, not the day, and no stored file is ever
    removed. Both give the same rows for a table that only this function writes.
    A driver lost at any point loses no row; the next merge finishes what it left.

    `key` names columns that tell rows apart, for tables with long texts: only
    these are compared, and an appending merge reads no others of the stored
    rows. Of rows with one key the stored one stays; of several new ones the least, as
    a whole, in both modes. `clock` is a column by whose range stored rows are narrowed.

    `new` is staged as a table in the scratch folder, and its days are observed while
    it is written. Pass `stage=False` if it is a plain table scan, and with it what
    was `seen` of its rows, or they are read once more.
    `task_rows` sizes the shuffle and, for few days, the files.
    """
    rows = new.select(*schema.names)
    timed = clock if not rewrite and clock in schema.names else None
    if stage:
        with observed(rows, "merge", *measures(timed)) as (table, found):
            return _merge(table, path, schema, task_rows, rewrite, key, timed, touched(found))
    if seen is None:
        seen = touched(rows.agg(*measures(timed)).first().asDict())
    return _merge(rows, path, schema, task_rows, rewrite, key, timed, seen)


def _merge(
    new: DataFrame,
    path: str,
    schema: StructType,
    task_rows: int,
    rewrite: bool,
    key: Sequence[str] | None,
    timed: str | None,
    seen: Touched,
) -> MergeReport:
    spark = new.sparkSession
    if seen.dayless:
        raise ValueError("rows without dt; keep them apart before the merge")
    if not seen.days:
        return MergeReport(())
    finish(spark, path)
    days, few = list(seen.days), len(seen.days) <= FEW_DAYS

    def stored(session: SparkSession) -> DataFrame:
        return stored_days(session, path, days, schema).select(*schema.names)

    if rewrite:
        # The footers of the files tell their rows.
        rows = stored(spark).count() + seen.rows
        both = stored(widened(spark, rows, task_rows))
        merged = dedupe_exact(union_prior(both, new)) if key is None else _first_by_key(both, new, key)
        tasks = packed(merged, rows, task_rows) if few else spread(merged, "dt")
        change_days(tasks, path, [f"dt={day}" for day in days])
        return MergeReport(tuple(days))
    prior = stored(spark)
    size = scan_bytes(prior)
    wide = widened(spark, max(size // STORED_ROW_BYTES, seen.rows * TASK_ROWS // task_rows))
    if wide is not spark:
        prior = stored(wide)
    if timed:
        prior = _near(prior, timed, [{"first": seen.first, "last": seen.last}])
    if size >= FILTER_BYTES:
        # A file of a rewritten day holds all its times, so only the filter keeps its rows from the shuffle.
        partners = may_be_in(new, key or new.columns, seen.rows)
        prior = prior if partners is None else prior.where(partners)
    missing = _missing(prior, new, key)
    if few:
        packed(missing, seen.rows, task_rows).write.mode("append").partitionBy("dt").parquet(path)
    else:
        append_days(missing, path)
    return MergeReport(tuple(days))


def stored_days(
    spark: SparkSession, path: str, days: Sequence[dt.date], schema: StructType
) -> DataFrame:
    """The stored rows of `days`, however many they are, without a shuffle.

    Beyond a list that fits a path, the days are sent to every task: their number
    is known here, and the calendar bounds it to a few million.
    """
    if len(days) <= MAX_LISTED_DAYS:
        return read_days(spark, path, days, schema)
    wanted = spark.createDataFrame([(day,) for day in days], "dt date")
    table = read_optional(spark, path, schema)
    table = table.where(F.col("dt").between(F.lit(days[0]), F.lit(days[-1])))
    return table.join(F.broadcast(wanted), "dt", "left_semi")


def _near(stored: DataFrame, clock: str, touched: Sequence[Mapping]) -> DataFrame:
    """Stored rows that may equal a new one, by the first and last time of the new rows or of parts of them.

    Equal rows have equal times. Appended files hold few hours each, so this
    skips most of the day by file statistics.
    """
    first = min((part["first"] for part in touched if part["first"] is not None), default=None)
    last = max((part["last"] for part in touched if part["last"] is not None), default=None)
    time = F.col(clock)
    return stored.where(time.between(F.lit(first), F.lit(last)) | time.isNull())


def _missing(stored: DataFrame, new: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """The distinct rows of `new` that are not in `stored`; one of each key.

    One aggregation over both, with the equality and the shuffle of a dedupe.
    """
    if key is None:
        key = new.columns
    # Of the stored rows only the key is read.
    rest = [name for name in new.columns if name not in key]
    row = F.struct(*rest) if rest else F.lit(True)
    keys_only = stored.select(*key, F.lit(True).alias("_stored"), F.lit(None).cast(_type_of(new, row)).alias("_rest"))
    both = keys_only.unionByName(new.select(*key, F.lit(False).alias("_stored"), row.alias("_rest")))
    # Whole rows are compared, so that no values of two rows are mixed.
    kept = both.groupBy(*key).agg(F.max("_stored").alias("_stored"), F.min("_rest").alias("_rest"))
    return _unfolded(kept.where(~F.col("_stored")), new.columns, rest)


def _first_by_key(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row of each key: a stored one where there is one, the least of several."""
    rest = [name for name in new.columns if name not in key]
    marked = stored.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    kept = marked.groupBy(*key).agg(F.min(F.struct("_new", *rest)).alias("_rest"))
    return _unfolded(kept, new.columns, rest)


def _unfolded(rows: DataFrame, columns: Sequence[str], rest: Sequence[str]) -> DataFrame:
    return rows.select(*[F.col("_rest").getField(c).alias(c) if c in rest else F.col(c) for c in columns])


def _type_of(df: DataFrame, column: Column):
    return df.select(column.alias("c")).schema["c"].dataType
