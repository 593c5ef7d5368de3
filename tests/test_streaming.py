"""Incremental loads give what the batch loads give, also when run again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom import samples
from tickloom.operators import day_slice
from tickloom.plans.jobs import daily_load, hourly_batch, warehouse_rows
from tickloom.scratch import fresh_path
from tickloom.samples import ZONE
from tickloom.schemas import QUARANTINE, TOPIC, WAREHOUSE
from tickloom.sources import read_days, read_ticks
from tickloom.streaming import stream_batch_layer, stream_lines, stream_topic, stream_warehouse
from tests.test_storage import content

SF_DIR = "/root/testdata/sf0.001"


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_batch_layer_stream(spark):
    raw, out = fresh_path(spark, "raw"), fresh_path(spark, "t")
    state, expected = fresh_path(spark, "state"), fresh_path(spark, "t")
    lines = spark.read.text(samples.written(spark, SF_DIR, "lines"))
    middle = F.lit("2024-01-15").cast("date")
    for part in (lines.where(F.col("dt") < middle), lines.where(F.col("dt") >= middle)):
        part.write.mode("append").partitionBy("dt").text(raw)
        for _ in range(2):
            stream = stream_lines(spark, raw, max_files=8)
            run(stream_batch_layer(stream, out, state, ZONE, f"{out}-q"))
    hourly_batch(spark, raw, expected, ZONE, quarantine=f"{expected}-q")
    assert content(read_ticks(spark, out)) == content(read_ticks(spark, expected))
    rejects = [spark.read.parquet(f"{path}-q") for path in (out, expected)]
    streamed, batched = (content(table.select("reason", "body")) for table in rejects)
    assert streamed == batched and sum(streamed.values()) > 0


def test_warehouse_stream(spark):
    topic, out = fresh_path(spark, "topic"), fresh_path(spark, "w")
    state = fresh_path(spark, "state")
    messages = spark.read.schema(TOPIC).parquet(samples.written(spark, SF_DIR, "topic"))
    for part in (messages.where("offset < 400"), messages.where("offset >= 400")):
        part.write.mode("append").parquet(topic)
        for _ in range(2):
            run(stream_warehouse(stream_topic(spark, topic), out, state, ZONE))
    assert content(read_ticks(spark, out, WAREHOUSE)) == content(warehouse_rows(messages, ZONE))


def test_stream_and_daily_loads_write_one_table(spark):
    topic, out, state = (fresh_path(spark, name) for name in ("topic", "w", "state"))
    messages = spark.read.schema(TOPIC).parquet(samples.written(spark, SF_DIR, "topic"))
    rows = warehouse_rows(messages, ZONE)
    first, second = "2024-01-10", "2024-01-11"
    early = messages.where(F.col("timestamp") < "2024-01-10 03:00:00")
    early.write.parquet(topic)
    run(stream_warehouse(stream_topic(spark, topic), out, state, ZONE))
    daily_load(messages, out, first, ZONE)  # a streamed day
    daily_load(messages, out, second, ZONE, "replace")  # a new day
    daily_load(messages, out, first, ZONE, "replace")
    expected = warehouse_rows(early, ZONE).unionByName(day_slice(rows, first)).distinct()
    expected = content(expected.unionByName(day_slice(rows, second)))
    assert content(read_ticks(spark, out, WAREHOUSE)) == expected
    days = [r.dt for r in read_ticks(spark, out, WAREHOUSE).select("dt").distinct().collect()]
    assert content(read_days(spark, out, days, WAREHOUSE)) == expected
    messages.where(F.col("timestamp") >= "2024-01-10 03:00:00").write.mode("append").parquet(topic)
    run(stream_warehouse(stream_topic(spark, topic), out, state, ZONE))
    assert content(read_ticks(spark, out, WAREHOUSE)) == content(rows)


def test_stream_keeps_messages_without_a_time(spark):
    topic, out, state = (fresh_path(spark, name) for name in ("topic", "w", "state"))
    at = dt.datetime(2024, 1, 10, 20, tzinfo=dt.timezone.utc)
    texts = ['{"coin":"A","date":"1704900000000"}', '{"coin":"B","date":"soon"}', "garbage"]
    rows = [(text.encode(), at) for text in texts]
    spark.createDataFrame(rows, "value binary, timestamp timestamp").write.parquet(topic)
    for _ in range(2):
        run(stream_warehouse(stream_topic(spark, topic), out, state, ZONE, f"{out}-q"))
    assert [r.coin for r in read_ticks(spark, out, WAREHOUSE).collect()] == ["A"]
    rejects = read_ticks(spark, f"{out}-q", QUARANTINE).collect()
    assert sorted((str(r.dt), r.reason, r.body) for r in rejects) == [
        ("2024-01-11", "message", "garbage"), ("2024-01-11", "time", texts[1])
    ]


def test_an_hour_landed_again_after_a_failed_run(spark):
    raw, out, state = (fresh_path(spark, name) for name in ("raw", "t", "state"))
    line = '{{"status":"0","data":{{"{}":{{"closing_price":"1"}},"date":"1636000000123"}}}}'

    def land(*coins):
        rows = [(line.format(coin), "2021-11-04", "13") for coin in coins]
        spark.createDataFrame(rows, "value string, dt string, hh string").coalesce(1).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy("dt", "hh").text(raw)

    land("A")
    with pytest.raises(Exception, match="Nowhere"):
        run(stream_batch_layer(stream_lines(spark, raw), out, state, "Nowhere/None"))
    land("A", "B")
    run(stream_batch_layer(stream_lines(spark, raw), out, state, ZONE))
    assert sorted(r.coin for r in read_ticks(spark, out).collect()) == ["A", "B"]
