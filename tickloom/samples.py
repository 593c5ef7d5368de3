"""Tick inputs in every source shape, derived by Spark from the `events` table.

An event is a quote: its type is the instrument, its value the closing price.
Each user is a feed whose n-th quotes of a day, of all instruments, make one
snapshot, so every event is in exactly one. The inputs grow with the table.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions import epoch_millis
from tickloom.hadoop import qualified
from tickloom.operators import (
    accepted,
    decode_envelope,
    explode_snapshot,
    normalize_ticks,
    partition_keys,
    with_civil_time,
)
from tickloom.scratch import fresh_path
from tickloom.schemas import FIELDS, TIME_KEY
from tickloom.sinks.layout import spread

ZONE = "Asia/Seoul"
# Numbers over which the small files of a folder are dealt, so that a large one is written by several tasks.
_DEALT = 64
_written: dict[tuple[str, str, str], str] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _quote() -> dict:
    value = F.col("value")
    k = F.get_json_object("props", "$.k").cast("double")
    user, event = F.col("user_id").cast("double"), F.col("event_id").cast("double")
    return {
        "acc_trade_value": event,
        "acc_trade_value_24H": event * 24,
        "closing_price": value,
        "fluctate_24H": value - k,
        "fluctate_rate_24H": value / 4,
        "max_price": F.greatest(value, k),
        "min_price": F.least(value, k),
        "opening_price": k,
        "prev_closing_price": value / 2,
        "units_traded": user,
        "units_traded_24H": user * 24,
    }


def _fields() -> list:
    quote = _quote()
    return [quote[name].cast("string").alias(name) for name in FIELDS]


def snapshots(events: DataFrame) -> DataFrame:
    """Envelopes of feeds and UTC days: `value`, `at` (UTC time of the latest quote).

    The status depends on the hour of `at`: 03 and 05 hold error codes, 07 has
    none, 04, 06 and 08 spell success in other ways.
    """
    day = F.col("ts").cast("date")
    in_order = Window.partitionBy("user_id", "day", "event_type").orderBy("ts", "event_id")
    quotes = events.withColumn("day", day).withColumn("nth", F.row_number().over(in_order))
    entry = F.struct("event_type", F.struct(*_fields()))
    feeds = quotes.groupBy("user_id", "day", "nth").agg(
        F.max("ts").alias("at"),
        # One entry per event type at most.
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("quotes"),
    )
    hour = F.hour("at")
    status = (
        F.when(hour == 3, '"5600"')
        .when(hour == 4, '"0"')
        .when(hour == 5, '"E1"')
        .when(hour == 6, '"00"')
        .when(hour == 7, "null")
        .when(hour == 8, '"0.0"')
        .otherwise('"0000"')
    )
    data = F.concat(
        F.expr("substring(quotes, 1, length(quotes) - 1)"),
        F.lit(f',"{TIME_KEY}":"'),
        epoch_millis(F.col("at")).cast("string"),
        F.lit('"}'),
    )
    value = F.concat(F.lit('{"status":'), status, F.lit(',"data":'), data, F.lit("}"))
    return feeds.select(value.alias("value"), "at")


def raw_lines(events: DataFrame) -> DataFrame:
    """Envelopes with the civil day they landed on: `value`, `dt`."""
    return partition_keys(snapshots(events), ZONE, "at").select("value", "dt")


def documents(events: DataFrame) -> DataFrame:
    """Envelopes spread over lines and padded with blanks: `value`, `dt` (text), `hh`."""
    keyed = partition_keys(snapshots(events), ZONE, "at")
    padded = F.regexp_replace("value", ',"', ',\r\n  "')
    return keyed.select(padded.alias("value"), F.col("dt_nodash").alias("dt"), "hh")


def messages(events: DataFrame) -> DataFrame:
    """One flat message per event, in the shape of a topic."""
    flat = F.struct(
        *_fields(),
        F.col("event_type").alias("coin"),
        epoch_millis(F.col("ts")).cast("string").alias(TIME_KEY),
    )
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(flat).cast("binary").alias("value"),
        F.lit("ticks").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis(epoch_millis(F.col("ts"))).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def ticks(events: DataFrame) -> DataFrame:
    """The batch rows of all envelopes with a good status."""
    decoded = with_civil_time(decode_envelope(raw_lines(events).select("value")), ZONE)
    return normalize_ticks(accepted(explode_snapshot(decoded)), ZONE)


def _write_each(docs: DataFrame, path: str) -> None:
    """A text file per document under `dt=…/hh=…`: many small writes, so as many tasks as there are cores.

    Hadoop's local file system starts a process for each file, to set its mode. So tasks write to a local or mounted
    folder themselves. Each folder's documents are dealt over `_DEALT` numbers, and those of one number are
    written in one task, under names that count up: a task that runs again writes the same names anew.
    """
    spark = docs.sparkSession
    tasks, folder = spark.sparkContext.defaultParallelism, qualified(spark, path)
    if not folder.startswith("file:"):
        docs.repartition(tasks).write.option("maxRecordsPerFile", 1).partitionBy("dt", "hh").text(path)
        return
    root, no_key = "/" + folder.removeprefix("file:").lstrip("/"), "__HIVE_DEFAULT_PARTITION__"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, below, number, count = None, "", 0, 0
        for batch in batches:
            for value, day, hour, deal in zip(*(column.to_pylist() for column in batch.columns)):
                if (day, hour, deal) != last:
                    last, number = (day, hour, deal), 0
                    below = f"{root}/dt={no_key if day is None else day}/hh={no_key if hour is None else hour}"
                    os.makedirs(below, exist_ok=True)
                with open(f"{below}/part-{deal:02d}-{number:06d}.txt", "wb") as out:
                    out.write((value or "").encode() + b"\n")
                number, count = number + 1, count + 1
        yield pa.record_batch({"files": pa.array([count], pa.int64())})

    keys = ("dt", "hh", "_deal")
    dealt = docs.select("value", "dt", "hh", F.pmod(F.xxhash64("value"), F.lit(_DEALT)).alias("_deal"))
    in_order = dealt.repartition(tasks, *keys).sortWithinPartitions(*keys, "value")
    in_order.mapInArrow(write, "files long").agg(F.sum("files")).collect()


def written(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The path of an input, written once per application to the scratch folder."""
    key = (spark.conf.get("spark.app.id", "local"), sf_dir, name)
    if key not in _written:
        path = fresh_path(spark, name)
        source = events(spark, sf_dir)
        if name == "lines":
            spread(raw_lines(source), "dt").write.partitionBy("dt").text(path)
        elif name == "documents":
            _write_each(documents(source), path)
        elif name == "topic":
            messages(source).write.parquet(path)
        elif name == "ticks":
            ticks(source).write.parquet(path)
        else:
            raise ValueError(f"unknown input: {name}")
        _written[key] = path
    return _written[key]
