"""Laws of merges by key, filtered merges, recoverable changes, the ledger, the offset index and packing."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tickloom import hadoop
from tickloom.functions import day_seconds
from tickloom.operators import day_slice, normalize_ticks, with_civil_day
from tickloom.operators.membership import MAX_BITS, filter_bits, may_be_in
from tickloom.plans.jobs import daily_load, daily_load_indexed, marked_messages, warehouse_rows
from tickloom.schemas import BATCH, QUARANTINE, TOPIC, WAREHOUSE
from tickloom.scratch import fresh_path, observed
from tickloom.sinks import append_once, changes, documents, merge_partitions, replace_day
from tickloom.sinks import merge as merge_module
from tickloom.sinks.changes import entry, finish, is_done
from tickloom.sinks.documents import Hour, compact_small_files, packed_hours
from tickloom.sources import list_documents, read_snapshots, read_ticks, read_topic_day, refresh_index
from tickloom.sources.offsets import day_ranges, range_options
from tests.test_storage import D1, D2, D3, LATE, ZONE, content, ticks

KEY = ("coin", "timestamp", "dt")


# Merges


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def always_filtered(monkeypatch):
    monkeypatch.setattr(merge_module, "FILTER_BYTES", 0)


@pytest.mark.parametrize("rewrite", [True, False])
def test_a_row_by_key_is_never_mixed_from_two(spark, rewrite):
    path = fresh_path(spark, "t")
    at = "2024-01-01 10:00:00"
    rows = ticks(spark, ("A", at, 1.0), ("A", at, 2.0))
    rows = rows.withColumn("opening_price", F.when(F.col("closing_price") == 1, 9.0).otherwise(3.0))
    merge_partitions(rows, path, rewrite=rewrite, key=KEY)
    merge_partitions(rows.withColumn("max_price", F.lit(0.5)), path, rewrite=rewrite, key=KEY)
    (row,) = read_ticks(spark, path).collect()
    assert (row.opening_price, row.closing_price, row.max_price) == (3.0, 2.0, None)


@pytest.mark.parametrize("seed", [1, 2])
def test_both_modes_keep_the_same_rows_by_key(spark, seed):
    rng = random.Random(seed)
    paths = {mode: fresh_path(spark, "t") for mode in (True, False)}
    for _ in range(4):
        batch = [
            (rng.choice("AB"), f"2024-01-{rng.randint(1, 12):02d} 10:00:00", rng.choice((None, 1.0, 2.0, 3.0)))
            for _ in range(rng.randint(1, 15))
        ]
        for mode, path in paths.items():
            merge_partitions(ticks(spark, *batch), path, rewrite=mode, key=KEY)
    rewritten, appended = (content(read_ticks(spark, path)) for path in paths.values())
    assert rewritten == appended and max(rewritten.values()) == 1


def test_filtered_merges_keep_the_set_of_all_rows(spark, always_filtered):
    rng = random.Random(5)
    path, model = fresh_path(spark, "t"), set()
    for _ in range(4):
        batch = [
            (rng.choice("AB"), f"2024-01-0{rng.randint(1, 9)} 10:00:00", rng.choice((None, float("nan"), -0.0, 2.0)))
            for _ in range(rng.randint(1, 12))
        ]
        merge_partitions(ticks(spark, *batch), path, rewrite=False)
        model |= {(c, t, "nan" if p is not None and p != p else p) for c, t, p in batch}
        assert content(read_ticks(spark, path)).keys() == content(
            ticks(spark, *((c, t, float("nan") if p == "nan" else p) for c, t, p in model))
        ).keys()


def test_the_filter_passes_partners_and_few_others(spark):
    rows = spark.range(40_000).selectExpr("id", "concat('c', id % 9) as coin", "if(id % 3 = 0, null, id / 7) as x")
    small = rows.where("id % 200 = 7")
    condition = may_be_in(small, ["coin", "x", "id"], 200)
    passed = rows.where(condition)
    assert passed.join(small, "id", "left_semi").count() == 200 and passed.count() < 200 + 40_000 * 0.03
    assert rows.where(may_be_in(small.limit(0), ["id"], 0)).count() == 0
    assert filter_bits(10**9) is None and filter_bits(1) >= 64 and filter_bits(5_000_000) == MAX_BITS
    assert may_be_in(small, ["id"], 10**9) is None


def test_a_rewritten_day_sends_only_likely_partners_to_the_shuffle(spark, always_filtered):
    path = fresh_path(spark, "t")
    day = spark.range(30_000).select(
        F.concat(F.lit("C"), F.col("id") % 50).alias("coin"),
        F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("id")), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        *[F.col("id").cast("double").alias(name) for name in BATCH.names[2:-1]],
        F.lit("2024-01-01").cast("date").alias("dt"),
    )
    merge_partitions(day, path)
    some = day.where("closing_price % 300 = 0")
    stored = read_ticks(spark, path)
    sent = stored.where(may_be_in(some, BATCH.names, 100))
    assert 100 <= sent.count() < 1500
    plan = plan_of(merge_module._missing(sent, some))
    assert plan.index("Exchange hashpartitioning") < plan.index("Subquery") and "FileScan" in plan
    merge_partitions(some.unionByName(ticks(spark, LATE)), path, rewrite=False)
    assert read_ticks(spark, path).count() == 30_001


def test_rows_are_observed_while_they_are_staged(spark):
    good = F.col("closing_price") > 1
    with observed(ticks(spark, D1, D2, D3), "x", *merge_module.measures("timestamp", when=good, prefix="g_")) as (rows, found):
        seen = merge_module.touched(found, "g_")
        assert rows.count() == 3
    assert seen.rows == 2 and [str(d) for d in seen.days] == ["2024-01-02", "2024-01-03"]
    assert (seen.first, seen.last, seen.dayless) == (D2[1], D3[1], 0)
    with observed(ticks(spark), "x", *merge_module.measures("timestamp")) as (rows, found):
        assert merge_module.touched(found) == merge_module.Touched((), 0)


def jobs_of(spark, action):
    """The descriptions of the jobs that an action starts."""
    group = fresh_path(spark, "jobs").rsplit("/", 1)[-1]
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_a_daily_load_counts_nothing_in_jobs_of_its_own(spark, session_settings):
    session_settings(adaptive="false")
    out = fresh_path(spark, "w")
    topic = messages(spark, ["2024-01-01 10:00:00"] * 3)
    # Staging and the append; nothing else.
    assert jobs_of(spark, lambda: daily_load(topic, out, "2024-01-01", ZONE)) == 2
    assert jobs_of(spark, lambda: daily_load(topic, out, "2024-01-01", ZONE)) <= 3


# Days by seconds


@pytest.mark.parametrize(
    "zone, day, hours, exact",
    [
        ("Asia/Seoul", "2024-01-15", 24, True),
        ("Europe/Berlin", "2024-03-31", 23, True),
        ("Europe/Berlin", "2024-10-27", 25, True),
        ("America/Sao_Paulo", "2018-11-04", 23, True),  # midnight does not exist
        ("America/Havana", "2024-11-03", 25, True),  # the first hour comes twice
        ("America/St_Johns", "2010-11-07", None, False),  # goes back over midnight
    ],
)
def test_a_day_lies_between_two_seconds(spark, zone, day, hours, exact):
    start, stop, known = day_seconds(dt.date.fromisoformat(day), zone)
    assert known == exact and (hours is None or stop - start == hours * 3600)
    seconds = list(range(start - 7200, stop + 7200, 300)) + [start - 1, start, stop - 1, stop]
    fields = ", ".join(f"cast(null as string) as {f}" for f in WAREHOUSE.names[3:-1])
    flat = spark.createDataFrame([(str(s * 1000 + 7),) for s in seconds] + [("soon",)], "date string")
    flat = flat.selectExpr("date", "'A' as coin", *fields.split(", "))
    want = content(day_slice(normalize_ticks(flat, zone, "warehouse"), day))
    got = normalize_ticks(with_civil_day(flat, day, zone, "warehouse"), zone, "warehouse")
    assert content(got) == want
    more = normalize_ticks(with_civil_day(flat, day, zone, "warehouse", timeless=True), zone, "warehouse")
    assert more.count() == got.count() + 1


def test_the_zone_is_looked_up_once_for_rows_of_the_day(spark):
    rows = messages(spark, ["2024-01-01 10:00:00"])
    for df in (warehouse_rows(rows, ZONE, "2024-01-01"), marked_messages(rows, ZONE, dt.date(2024, 1, 1))):
        assert plan_of(df).count("from_utc_timestamp") == 1


# Changes


class Lost(Exception):
    pass


def lose_after(monkeypatch, steps):
    """Every file operation counts; the driver is lost before the one after `steps`."""
    left = [steps]

    def guarded(operation):
        def run(*args):
            if left[0] == 0:
                raise Lost
            left[0] -= 1
            return operation(*args)

        return run

    for name in ("move", "remove", "write_text"):
        monkeypatch.setattr(hadoop, name, guarded(getattr(hadoop, name)))


@pytest.mark.parametrize("how", ["merge", "replace"])
def test_a_driver_lost_at_any_step_loses_no_row(spark, how):
    new = ticks(spark, LATE, D2) if how == "merge" else ticks(spark, LATE, D1)

    def load(path):
        if how == "merge":
            return merge_partitions(new, path)
        return replace_day(new, path, "2024-01-01")

    stored = ticks(spark, D1, D2, D3)
    whole = content(ticks(spark, D1, D2, D3, LATE))
    for steps in range(40):
        path = fresh_path(spark, "t")
        merge_partitions(stored, path)
        with pytest.MonkeyPatch.context() as patch:
            lose_after(patch, steps)
            try:
                load(path)
                lost = False
            except Lost:
                lost = True
        held = content(read_ticks(spark, path))
        assert not content(stored) - held, f"rows are missing after {steps} steps"
        load(path)
        assert content(read_ticks(spark, path)) == whole
        if not lost:
            break
    assert steps > 4 and not lost


def test_an_undecided_change_leaves_nothing(spark):
    path = fresh_path(spark, "t")
    merge_partitions(ticks(spark, D1), path)
    with pytest.raises(Exception, match="no"):
        changes.change_days(ticks(spark, D2).withColumn("coin", F.raise_error(F.lit("no"))), path)
    assert finish(spark, path) == [] and hadoop.folders(spark, f"{path}/_changes/new/*") == []
    assert content(read_ticks(spark, path)) == content(ticks(spark, D1))


def test_a_load_with_a_name_counts_once(spark):
    path = fresh_path(spark, "t")
    twice = ticks(spark, D1, D1, D2)
    assert append_once(twice, path, "load-1", {"offsets": [1, 2]})
    assert not append_once(twice, path, "load-1")
    assert append_once(ticks(spark, D1), path, "load-2")
    assert content(read_ticks(spark, path)) == content(ticks(spark, D1, D1, D1, D2))
    assert is_done(spark, path, "load-1") and entry(spark, path, "load-1")["note"] == {"offsets": [1, 2]}
    with pytest.raises(ValueError):
        append_once(twice, path, "../load")


def test_a_named_load_lost_on_the_way_is_finished_not_repeated(spark):
    whole = content(ticks(spark, D1, D1, D2))
    for steps in range(20):
        path = fresh_path(spark, "t")
        with pytest.MonkeyPatch.context() as patch:
            lose_after(patch, steps)
            try:
                append_once(ticks(spark, D1, D1, D2), path, "load")
                lost = False
            except Lost:
                lost = True
        append_once(ticks(spark, D1, D1, D2), path, "load")
        assert content(read_ticks(spark, path)) == whole
        if not lost:
            break
    assert not lost


# The offset index


def messages(spark, times, partition=0, first=0, coin="A"):
    """One message a time (Seoul), or without one for null, at successive offsets."""
    rows = []
    for i, at in enumerate(times):
        ms = "soon"
        if at is not None:
            wall = dt.datetime.fromisoformat(at).replace(tzinfo=dt.timezone(dt.timedelta(hours=9)))
            ms = str(int(wall.timestamp()) * 1000)
        value = json.dumps({"coin": coin, "date": ms, "closing_price": str(first + i)}).encode()
        rows.append((None, bytearray(value), "ticks", partition, first + i, None, 0, None))
    return spark.createDataFrame(rows, TOPIC)


def test_an_index_names_the_ranges_of_a_day(spark):
    topic, index = fresh_path(spark, "topic"), fresh_path(spark, "index")
    day, other = "2024-01-01 12:00:00", "2024-01-02 12:00:00"
    messages(spark, [day] * 15 + [other] * 30 + [day] + [None] * 4).write.parquet(topic)
    messages(spark, [other] * 20, partition=1).write.mode("append").parquet(topic)
    for _ in range(2):
        refresh_index(spark, topic, index, ZONE, block=10)
        assert day_ranges(spark, index, "2024-01-01", ZONE) == [("ticks", 0, 0, 14), ("ticks", 0, 45, 45)]
    assert day_ranges(spark, index, "2024-01-01", "UTC") == []
    assert day_ranges(spark, index, "2024-01-01", ZONE, timeless=True)[-1] == ("ticks", 0, 45, 49)
    messages(spark, [day, other], first=50).write.mode("append").parquet(topic)
    messages(spark, [day] * 3, partition=2).write.mode("append").parquet(topic)
    refresh_index(spark, topic, index, ZONE, block=10)
    assert spark.read.parquet(index).agg(F.sum("messages")).first()[0] == 75
    ranges = day_ranges(spark, index, "2024-01-01", ZONE)
    assert ranges == [("ticks", 0, 0, 14), ("ticks", 0, 45, 50), ("ticks", 2, 0, 2)]
    read = read_topic_day(spark, topic, index, "2024-01-01", ZONE)
    assert read.count() == 15 + 6 + 3 and "GreaterThanOrEqual(of" in plan_of(read).split("PushedFilters")[1].split("ReadSchema")[0]
    assert read_topic_day(spark, topic, index, "2030-01-01", ZONE).count() == 0


def test_a_long_list_of_ranges_becomes_one_a_partition(spark, monkeypatch):
    topic, index = fresh_path(spark, "topic"), fresh_path(spark, "index")
    times = ["2024-01-01 12:00:00", "2024-01-02 12:00:00"] * 20
    messages(spark, times).write.parquet(topic)
    refresh_index(spark, topic, index, ZONE, block=1)
    assert len(day_ranges(spark, index, "2024-01-02", ZONE)) == 20
    monkeypatch.setattr("tickloom.sources.offsets.MAX_RANGES", 5)
    assert day_ranges(spark, index, "2024-01-02", ZONE) == [("ticks", 0, 1, 39)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_load_through_the_index_is_the_full_load(spark, seed):
    rng = random.Random(seed)
    topic, index, out, full = (fresh_path(spark, name) for name in ("topic", "index", "w", "f"))
    ends = {0: 0, 1: 0}
    for _ in range(3):
        for partition in ends:
            times = [
                rng.choice([None, f"2024-01-0{rng.randint(1, 3)} {rng.randint(0, 23):02d}:30:00"])
                for _ in range(rng.randint(1, 40))
            ]
            rows = messages(spark, times, partition, ends[partition], f"P{partition}")
            rows.write.mode("append").parquet(topic)
            ends[partition] += len(times)
        for day in ("2024-01-01", "2024-01-02"):
            daily_load_indexed(spark, topic, index, out, day, ZONE, block=7, quarantine=f"{out}-q")
            daily_load(spark.read.schema(TOPIC).parquet(topic), full, day, ZONE, quarantine=f"{full}-q")
    assert content(read_ticks(spark, out, WAREHOUSE)) == content(read_ticks(spark, full, WAREHOUSE))
    assert content(read_ticks(spark, f"{out}-q", QUARANTINE)) == content(read_ticks(spark, f"{full}-q", QUARANTINE))


def test_connector_options_of_ranges():
    server = {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b"}
    first, second = range_options(server, [("a", 0, 5, 9), ("a", 0, 20, 20), ("b", 3, 0, 1)])
    assert json.loads(first["assign"]) == {"a": [0], "b": [3]} and "subscribe" not in first
    assert json.loads(first["startingOffsets"]) == {"a": {"0": 5}, "b": {"3": 0}}
    assert json.loads(first["endingOffsets"]) == {"a": {"0": 10}, "b": {"3": 2}}
    assert json.loads(second["startingOffsets"]) == {"a": {"0": 20}}
    assert range_options(server, []) == []


# Compaction


def hour(number, count, size=1):
    return Hour(dt.date(2024, 1, 1) + dt.timedelta(days=number // 24), f"{number % 24:02d}", count, size)


def test_hours_are_packed_by_hours_documents_and_bytes():
    found = [hour(0, 20_000), hour(1, 1_000_000), *(hour(i, 100) for i in range(2, 746))]
    first, tasks = packed_hours(found)
    assert found[0].parts == 2 and found[1].parts == 100 and tasks == 102 + 47
    held = {}
    for h, task in first.items():
        held.setdefault(task, []).append(h)
    assert max(map(len, held.values())) <= documents.TASK_HOURS
    assert sorted(first, key=lambda h: (h.dt, h.hh)) == found
    first, tasks = packed_hours([hour(i, 6000 if i % 2 else 4000) for i in range(10)])
    assert tasks == 5
    assert packed_hours([hour(0, 5, documents.TASK_BYTES * 3)])[1] == 3
    assert packed_hours([]) == ({}, 0)


def test_a_large_hour_takes_its_own_tasks_whatever_lies_beside_it(spark, monkeypatch):
    monkeypatch.setattr(documents, "TASK_DOCUMENTS", 100)
    monkeypatch.setattr(documents, "HOURS_AT_ONCE", 3)
    rows = spark.range(900).select(
        F.lit("{ same }").alias("value"),
        F.lit("20240101").alias("dt"),
        F.expr("case when id < 600 then '01' when id < 800 then '02' else lpad(string(id % 20 + 3), 2, '0') end").alias("hh"),
    )
    src, dst = fresh_path(spark, "small"), fresh_path(spark, "lines")
    rows.repartition(8).write.option("maxRecordsPerFile", 1).partitionBy("dt", "hh").text(src)
    listed = list_documents(spark, src)
    assert listed.count() == 900 and listed.select("path").distinct().count() == 900
    assert [(h.hh, h.documents) for h in documents.hours(listed)[:2]] == [("01", 600), ("02", 200)]
    for _ in range(2):
        compact_small_files(spark, src, dst)
        assert read_snapshots(spark, dst).count() == 900
        files = {h: len(read_snapshots(spark, dst, hour=h).inputFiles()) for h in (1, 2, 3, 22)}
        assert files == {1: 6, 2: 2, 3: 1, 22: 1}
