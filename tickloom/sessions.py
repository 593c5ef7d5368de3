"""Sessions that differ from the caller's in one setting."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What a small file counts for, in bytes, when files are packed to tasks.
OPEN_COST, FILE_COST = "spark.sql.files.openCostInBytes", 64 << 10


def crowded(spark: SparkSession) -> SparkSession:
    """A session whose scans give a task some thousand small files, as long as every core has a task.

    Spark's default takes a file for no less than 4 MB, so a task gets 32 of them, and small files take a
    hundred thousand tasks for every three million. The given session stays as it is.
    """
    if int(spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()) <= FILE_COST:
        return spark
    return with_setting(spark, OPEN_COST, FILE_COST)


def with_setting(spark: SparkSession, setting: str, value: int) -> SparkSession:
    """A new session with the settings of this one, but for one."""
    other = spark.newSession()
    for name, known in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            other.conf.set(name, known)
    other.conf.set(setting, str(value))
    return other
