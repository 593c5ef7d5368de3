"""The plans we want: one parse per line, no Python, pruned scans, few shuffles."""

import datetime as dt

from pyspark.sql import functions as F

from tickloom import samples
from tickloom.operators import accepted, dedupe_exact
from tickloom.plans.jobs import batch_rows, warehouse_rows
from tickloom.scratch import fresh_path
from tickloom.sinks import overwrite_days
from tickloom.sources import read_days, read_snapshots, read_ticks, read_topic

SF_DIR = "/root/testdata/sf0.001"
ENVELOPE_PARSE = "from_json(StructField(status,StringType,true), StructField(data,MapType"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_snapshots_are_parsed_once_and_without_python(spark):
    lines = read_snapshots(spark, samples.written(spark, SF_DIR, "lines"))
    rows = accepted(batch_rows(lines, "Asia/Seoul"))
    text = plan(rows)
    assert "Python" not in text and "Exchange" not in text
    assert optimized(rows).count("from_json(StructField(status") == 1
    assert optimized(rows).count(ENVELOPE_PARSE) == 1
    # The payload map must not be copied into every instrument's row.
    generate = next(line for line in text.splitlines() if "Generate explode" in line)
    assert "payload" not in generate.split("false, [")[0].rsplit("), [", 1)[-1]


def test_one_day_of_raw_lines_lists_one_day(spark):
    path = samples.written(spark, SF_DIR, "lines")
    one = read_snapshots(spark, path, "2024-01-15")
    assert {name.split("/dt=")[1][:10] for name in one.inputFiles()} == {"2024-01-15"}
    assert one.count() == read_snapshots(spark, path).where("dt = date'2024-01-15'").count() > 0


def test_a_filter_on_raw_days_prunes_files(spark):
    lines = read_snapshots(spark, samples.written(spark, SF_DIR, "lines"))
    executed = lines.where("dt = date'2024-01-15'")._jdf.queryExecution().executedPlan()
    assert executed.execute().count() > 0
    scan = executed.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1


def test_day_predicate_prunes_partitions(spark):
    path = fresh_path(spark, "table")
    overwrite_days(samples.ticks(samples.events(spark, SF_DIR)), path)
    text = plan(read_ticks(spark, path).where(F.col("dt") == F.lit(dt.date(2024, 1, 15))))
    assert "PartitionFilters: [isnotnull(dt" in text
    assert len(read_days(spark, path, ["2024-01-15"]).inputFiles()) == 1


def test_column_pruning_reaches_the_scan(spark):
    path = fresh_path(spark, "table")
    overwrite_days(samples.ticks(samples.events(spark, SF_DIR)), path)
    text = plan(read_ticks(spark, path).select("coin", "closing_price"))
    assert "ReadSchema: struct<coin:string,closing_price:double>" in text


def test_topic_time_bound_reaches_the_scan(spark):
    path = samples.written(spark, SF_DIR, "topic")
    topic = read_topic(spark, path, "2024-01-15", "Asia/Seoul", dt.timedelta(hours=1))
    assert "GreaterThanOrEqual(timestamp" in plan(warehouse_rows(topic, "Asia/Seoul"))


def test_copies_collapse_before_the_only_shuffle(spark):
    rows = dedupe_exact(spark.range(10).selectExpr("id % 2 as a", "id % 3 as b"))
    text = plan(rows)
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
