"""Written intermediate tables in the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tickloom.hadoop import remove

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_roots: dict[str, tempfile.TemporaryDirectory] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, or a temporary one in local mode."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor reaches")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        # Removed when the interpreter ends.
        _local_roots[app] = tempfile.TemporaryDirectory(prefix="tickloom-", ignore_cleanup_errors=True)
    return _local_roots[app].name


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`df` written once and read back, so that later passes do not recompute it.

    The table survives the loss of executors. It is removed at the end.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


@contextmanager
def observed(df: DataFrame, label: str, *measures: Column) -> Iterator[tuple[DataFrame, dict[str, object]]]:
    """The staged table, and the values of the aggregates `measures`, taken while it is written.

    A task that runs again may be counted again, so counts are bounds where an executor is lost: use
    them for sizes, and the others for what repetition does not change.
    """
    seen = Observation()
    with staged(df.observe(seen, *measures), label) as table:
        yield table, seen.get
