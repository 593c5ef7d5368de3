"""Times the headline queries and prints one JSON line.

Inputs (raw lines, small files, topic, tick tables) are written before the clock starts,
as the jobs find them, and so is the table that a merge adds its rows to. Every query
runs `REPEATS` times, the compaction once; its best time counts. The `comparison` times
are not part of the total.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import samples
from tickloom.operators import (
    accepted,
    day_slice,
    decode_envelope,
    dedupe_exact,
    explode_snapshot,
    normalize_ticks,
    partition_counts,
    with_civil_time,
)
from tickloom.plans.jobs import daily_load, hourly_batch, warehouse_rows
from tickloom.scratch import fresh_path
from tickloom.samples import ZONE
from tickloom.schemas import BATCH, FIELDS
from tickloom.sinks import append_days, compact_small_files, merge_partitions, overwrite_days
from tickloom.sources import read_days, read_snapshots, read_ticks, read_topic

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
DAY = "2024-01-15"
MARKS = ("reason", "body")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tickloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(result: DataFrame | None) -> None:
    if result is not None:
        result.write.format("noop").mode("overwrite").save()


def best(action, prepare=None, repeats: int = REPEATS) -> float:
    times = []
    for _ in range(repeats):
        given = [prepare()] if prepare else []
        start = time.perf_counter()
        run(action(*given))
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def row_udf_ticks(lines: DataFrame) -> DataFrame:
    """The same rows through a Python function called per line: for comparison only."""
    schema = "array<struct<coin:string,timestamp:string,{}>>".format(
        ",".join(f"{name}:string" for name in FIELDS)
    )

    @F.udf(schema)
    def instruments(text):
        items = json.loads(text)
        at = items.get("date")
        return [
            (coin, at, *[fields.get(name) for name in FIELDS])
            for coin, fields in items.items()
            if coin != "date"
        ]

    good = lines.select(F.from_json("value", "status string, data string").alias("e")).where(
        F.col("e.status").try_cast("bigint") == 0
    )
    return normalize_ticks(good.select(F.inline(instruments("e.data"))), ZONE)


def main() -> None:
    spark = session()
    lines = samples.written(spark, SF_DIR, "lines")
    topic = samples.written(spark, SF_DIR, "topic")
    ticks = spark.read.schema(BATCH).parquet(samples.written(spark, SF_DIR, "ticks"))
    table = fresh_path(spark, "bench")
    overwrite_days(ticks, table)
    documents = samples.written(spark, SF_DIR, "documents")
    hour = F.substring("timestamp", 12, 2).cast("int")
    prior, new = ticks.where(hour < 16), ticks.where(hour >= 8)

    def half_filled() -> str:
        """A table that lacks a third of the rows, so that a merge has some to add."""
        path = fresh_path(spark, "half")
        overwrite_days(prior, path)
        return path

    def decoded() -> DataFrame:
        snapshots = with_civil_time(decode_envelope(read_snapshots(spark, lines)), ZONE)
        return accepted(normalize_ticks(explode_snapshot(snapshots), ZONE, keep=MARKS))

    queries = {
        "snapshot_explode": decoded,
        "normalize_tick": lambda: warehouse_rows(read_topic(spark, topic), ZONE),
        "day_slice": lambda: day_slice(warehouse_rows(read_topic(spark, topic), ZONE, DAY), DAY),
        "day_slice_bounded": lambda: day_slice(
            warehouse_rows(read_topic(spark, topic, DAY, ZONE, dt.timedelta(hours=1)), ZONE, DAY), DAY
        ),
        "partition_counts": lambda: partition_counts(read_snapshots(spark, lines)),
        "dedupe_exact": lambda: dedupe_exact(read_ticks(spark, table)),
        "partition_pinned_scan": lambda: read_days(spark, table, [DAY]),
        "hourly_batch": lambda: run_job(hourly_batch, spark, lines, fresh_path(spark, "b"), ZONE),
        "hourly_batch_one_day": lambda: run_job(hourly_batch, spark, lines, table, ZONE, DAY),
        "daily_load": lambda: run_job(
            daily_load, read_topic(spark, topic), fresh_path(spark, "w"), DAY, ZONE
        ),
        "append_partitioned": lambda: run_job(append_days, ticks, fresh_path(spark, "a")),
    }
    day = day_slice(new, DAY)
    merges = {
        "merge_all_days": lambda path: run_job(merge_partitions, new, path),
        "merge_all_days_append": lambda path: merge_partitions_append(new, path),
        "merge_one_day": lambda path: run_job(merge_partitions, day, path),
        "merge_one_day_append": lambda path: merge_partitions_append(day, path),
    }
    times = {name: best(action) for name, action in queries.items()}
    times |= {name: best(action, half_filled) for name, action in merges.items()}
    compact = lambda: run_job(compact_small_files, spark, documents, fresh_path(spark, "c"))
    times["compact_small_files"] = best(compact, repeats=1)
    # Each line sixteen times, so that the work outweighs the planning.
    many = read_snapshots(spark, lines).select(
        "value", F.explode(F.sequence(F.lit(1), F.lit(16)))
    ).select("value")
    native = explode_snapshot(with_civil_time(decode_envelope(many), ZONE))
    comparison = {
        "native_explode_x16": best(lambda: accepted(normalize_ticks(native, ZONE, keep=MARKS))),
        "row_udf_explode_x16": best(lambda: row_udf_ticks(many)),
    }
    print(
        json.dumps(
            {
                "metric": "total of best query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "comparison": comparison,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


def merge_partitions_append(new: DataFrame, table: str) -> None:
    merge_partitions(new, table, rewrite=False)


def run_job(job, *args) -> None:
    job(*args)


if __name__ == "__main__":
    main()
