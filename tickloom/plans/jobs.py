"""The three loads, from source to table. Paths, days and zones are arguments."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.days import as_date
from tickloom.functions import civil_date, civil_time
from tickloom.operators import (
    accepted,
    decode_envelope,
    decode_flat,
    explode_snapshot,
    normalize_ticks,
    rejected,
    with_civil_day,
    with_civil_time,
)
from tickloom.scratch import observed
from tickloom.schemas import BATCH, FIELDS, QUARANTINE, QUARANTINE_KEY, TIME_KEY, WAREHOUSE
from tickloom.sinks import append_days, append_once, compact_small_files, merge_partitions, replace_day
from tickloom.sinks.merge import CLOCK, MergeReport, Touched, measures, touched
from tickloom.sources import read_snapshots, read_topic_day, refresh_index
from tickloom.sources.offsets import BLOCK, day_ranges


NO_DAY = dt.date(1970, 1, 1)
# Whole raw lines are hundreds of times larger than tick rows.
TASK_LINES = 10_000


@dataclass(frozen=True)
class BatchReport:
    merged: MergeReport
    rejects: dict[str, int] = field(default_factory=dict)


def land_hour(
    spark: SparkSession, src: str, dst: str, instant: dt.datetime | str, zone: str
) -> tuple[dt.date, int]:
    """Lands the hour of `instant`: small files to lines. Gives its day and hour in `zone`.

    The instant is a datetime or ISO text, in UTC if it names no offset.
    """
    if isinstance(instant, str):
        instant = dt.datetime.fromisoformat(instant)
    aware = instant if instant.tzinfo else instant.replace(tzinfo=dt.timezone.utc)
    wall = aware.astimezone(ZoneInfo(zone))
    compact_small_files(spark, src, dst, wall.date(), wall.hour)
    return wall.date(), wall.hour


def batch_rows(lines: DataFrame, zone: str) -> DataFrame:
    """Raw lines to batch rows, with rejects marked, in one pass and no shuffle.

    Adds `line_dt` and `landed` (the partition the line came from), `reason`, `body` and the
    body's `digest`.
    """
    if "landed" not in lines.columns:
        lines = lines.withColumn("landed", F.lit(None).cast("int"))
    snapshots = decode_envelope(lines.withColumnRenamed("dt", "line_dt"))
    rows = explode_snapshot(with_civil_time(snapshots, zone))
    marks = ("line_dt", "landed", "reason", "body")
    ticks = normalize_ticks(rows, zone, "batch", keep=marks)
    return ticks.withColumn("digest", F.sha2("body", 256))


def hourly_batch(
    spark: SparkSession,
    raw: str,
    out: str,
    zone: str,
    day: dt.date | str | None = None,
    until: dt.date | str | None = None,
    hour: int | None = None,
    quarantine: str | None = None,
    rewrite: bool = True,
) -> BatchReport:
    """Merges the raw snapshots of `day` (or a range, or all) into the batch table.

    With `hour` only the lines that landed in that hour are parsed. Run each
    hour, this gives the table that parsing the whole day each hour gives. With
    `rewrite=False` it also writes no more than that hour's rows; see
    `merge_partitions`.
    """
    lines = read_snapshots(spark, raw, day, until, hour)
    return load_batch(lines, out, zone, quarantine, rewrite)


def load_batch(
    lines: DataFrame,
    out: str,
    zone: str,
    quarantine: str | None = None,
    rewrite: bool = True,
) -> BatchReport:
    """Merges raw lines into the batch table, and their rejects into `quarantine`.

    The text is parsed once, into a staged table that serves the touched days,
    the merge, the reject counts and the quarantine. Both merges are safe to
    repeat.
    """
    good_ones, rows = F.col("reason").isNull(), batch_rows(lines, zone)
    with observed(rows, "batch", *measures(None if rewrite else CLOCK, when=good_ones)) as (rows, found):
        good = accepted(rows).select(*BATCH.names)
        merged = merge_partitions(good, out, BATCH, stage=False, rewrite=rewrite, seen=touched(found))
        bad = rejected(rows)
        counts = {row.reason: row["count"] for row in bad.groupBy("reason").count().collect()}
        if quarantine is not None and counts:
            # A line outside any day directory goes under the first day.
            landed = F.coalesce("line_dt", F.lit(NO_DAY)).alias("dt")
            rejects = bad.select("reason", "coin", "body", "digest", "landed", landed)
            _keep_rejects(rejects, quarantine, rewrite)
    return BatchReport(merged, counts)


def _keep_rejects(
    rejects: DataFrame, quarantine: str, rewrite: bool = False, seen: Touched | None = None
) -> None:
    """Merges rejects by their digest: no stored text is read, and none is shuffled twice."""
    merge_partitions(
        rejects,
        quarantine,
        QUARANTINE,
        stage=False,
        task_rows=TASK_LINES,
        rewrite=rewrite,
        key=QUARANTINE_KEY,
        clock="landed",
        seen=seen,
    )


def warehouse_rows(messages: DataFrame, zone: str, day: dt.date | str | None = None) -> DataFrame:
    """Topic messages to warehouse rows of every day, or of one; `dt` is null without a time."""
    flat = decode_flat(messages)
    if day is not None:
        flat = with_civil_day(flat, day, zone, "warehouse")
    return normalize_ticks(flat, zone, "warehouse")


def _observed_messages(rows: DataFrame, rejects_dt: Column):
    """Staged messages, and what is known of the good ones (`good_`) and of the rejects (`bad_`)."""
    good = F.col("reason").isNull()
    bad = measures("landed", rejects_dt, ~good, "bad_")
    return observed(rows, "messages", *measures(CLOCK, when=good, prefix="good_"), *bad)


def daily_load(
    messages: DataFrame,
    out: str,
    day: dt.date | str,
    zone: str,
    mode: str = "merge",
    files: int | None = None,
    quarantine: str | None = None,
    shrink: bool = False,
    load: str | None = None,
    note: dict | None = None,
) -> None:
    """Loads the messages of one civil day into the warehouse table.

    `merge` adds the rows that the day lacks: safe to repeat, and it never removes a row, also when
    the topic has forgotten some. Rows that are equal in every column become one. `append` adds all
    rows once more on each run, or with the name of a `load` once for each name: the table's ledger keeps
    the name and the `note`. `replace` makes the messages the whole day; it refuses to leave the
    day with fewer rows than it has unless `shrink` says so.

    Messages without a usable time belong to no day. With `quarantine` the run merges them into
    that table, under the day it loads.
    """
    if mode not in ("merge", "append", "replace"):
        raise ValueError(f"unknown mode: {mode}")
    day = as_date(day)
    landed = F.lit(day)
    with _observed_messages(marked_messages(messages, zone, day), landed) as (rows, found):
        good = rows.where(F.col("reason").isNull()).select(*WAREHOUSE.names)
        if mode == "append" and load is not None:
            append_once(good, out, load, {"day": day.isoformat(), **(note or {})}, files)
        elif mode == "append":
            append_days(good, out, files)
        elif mode == "merge":
            merge_partitions(good, out, WAREHOUSE, stage=False, rewrite=False, seen=touched(found, "good_"))
        else:
            replace_day(good, out, day, files, stage=False, shrink=shrink)
        if quarantine is not None:
            rejects = rows.where(F.col("reason").isNotNull()).select(*QUARANTINE.names[:-1], landed.alias("dt"))
            _keep_rejects(rejects, quarantine, seen=touched(found, "bad_"))


def daily_load_indexed(
    spark: SparkSession,
    source: str | dict[str, str],
    index: str,
    out: str,
    day: dt.date | str,
    zone: str,
    block: int = BLOCK,
    **options,
) -> None:
    """`daily_load` of a topic through its offset index, which learns first what has come since.

    Reads each message once for the index, over all loads, and the ranges of offsets that hold messages of
    the day. With a quarantine also those that hold messages without a time. `options` are those of
    `daily_load`; the ranges go to the ledger of an append with a name.
    """
    refresh_index(spark, source, index, zone, block)
    timeless = options.get("quarantine") is not None
    messages = read_topic_day(spark, source, index, day, zone, timeless)
    ranges = [list(r) for r in day_ranges(spark, index, day, zone)]
    daily_load(messages, out, day, zone, note={"offsets": ranges}, **options)


def load_messages(messages: DataFrame, out: str, zone: str, quarantine: str | None = None) -> None:
    """Merges messages of all days into the warehouse table, and those without a time into `quarantine`.

    Safe to repeat. Rejects go under the civil day on which they arrived.
    """
    arrived = F.coalesce("arrived", F.lit(NO_DAY))
    with _observed_messages(marked_messages(messages, zone), arrived) as (rows, found):
        good = rows.where(F.col("reason").isNull()).select(*WAREHOUSE.names)
        merge_partitions(good, out, WAREHOUSE, stage=False, rewrite=False, seen=touched(found, "good_"))
        if quarantine is not None:
            rejects = rows.where(F.col("reason").isNotNull()).select(*QUARANTINE.names[:-1], arrived.alias("dt"))
            _keep_rejects(rejects, quarantine, seen=touched(found, "bad_"))


def marked_messages(messages: DataFrame, zone: str, day: dt.date | None = None) -> DataFrame:
    """Warehouse rows with `reason`, `body`, `digest` and the day they `arrived`, in one pass.

    With `day` only the rows of that day, and those of none; these go under that day, so when they
    arrived is not worked out. The reason is `message` for one without any known field and `time` for
    one without a usable time.
    """
    arrival = F.lit(None).cast("date")
    if "timestamp" in messages.columns and day is None:
        arrival = civil_date(civil_time(F.unix_seconds("timestamp"), zone))
    flat = decode_flat(messages.withColumn("_arrived", arrival), keep=("value", "_arrived"))
    flat = flat.withColumn("_empty", F.coalesce(*FIELDS, "coin", TIME_KEY).isNull())
    if day is not None:
        flat = with_civil_day(flat, day, zone, "warehouse", timeless=True)
    rows = normalize_ticks(flat, zone, "warehouse", keep=("value", "_empty", "_arrived"))
    timeless = F.col("dt").isNull()
    body = F.when(timeless, F.col("value").cast("string"))
    return rows.select(
        *WAREHOUSE.names,
        F.when(timeless & F.col("_empty"), F.lit("message"))
        .when(timeless, F.lit("time"))
        .alias("reason"),
        body.alias("body"),
        F.sha2(body, 256).alias("digest"),
        F.lit(None).cast("int").alias("landed"),
        F.col("_arrived").alias("arrived"),
    )
