"""How rows are spread over write tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sessions import OPEN_COST, crowded, with_setting  # noqa: F401

# Tick rows per task: some 250 MB in memory, and a file of some ten to a hundred
# MB. Rows are counted because file sizes tell little: in another order the same
# rows can take several times the space.
TASK_ROWS = 2_000_000

SHUFFLE_TASKS = "spark.sql.shuffle.partitions"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Gathers rows by `keys` for the writer, without one task per hot key.

    With adaptive execution a rebalance splits large keys by size and packs
    small ones together. Without it a range shuffle does, by a sample of the
    rows: in order of key, then of the row's values and the task it comes from.
    So equal rows of several tasks part too, and a repeated task gets the same
    rows.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *keys)
    rest = [name for name in df.columns if name not in keys]
    marked = df.withColumn("_task", F.spark_partition_id())
    marked = marked.withColumn("_place", F.xxhash64("_task", *rest))
    return marked.repartitionByRange(*keys, "_place").drop("_task", "_place")


def packed(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """Joins small tasks into fewer, fuller ones without a shuffle.

    A wide cluster reads a small day in thousands of slivers, and each would
    become a file.
    """
    return df.coalesce(max(1, -(-rows // task_rows)))


def widened(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> SparkSession:
    """A session whose shuffles have a task for every `task_rows` rows, or more.

    Adaptive execution joins small shuffle tasks, but cannot split those of a
    dedupe. The given session and its settings stay as they are; if it is wide
    enough it is returned itself.
    """
    needed = -(-rows // task_rows)
    if needed <= int(spark.conf.get(SHUFFLE_TASKS)):
        return spark
    return with_setting(spark, SHUFFLE_TASKS, needed)
