import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tickloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def session_settings(spark):
    """Sets session options for one test and puts the old ones back."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = {"zone": "spark.sql.session.timeZone", "ansi": "spark.sql.ansi.enabled",
                   "adaptive": "spark.sql.adaptive.enabled"}[name]
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)
