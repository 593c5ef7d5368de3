"""Edge rows of the decoders, under several session settings."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions import civil_date, civil_text, civil_time, seconds_from_millis
from tickloom.operators import (
    accepted,
    decode_envelope,
    decode_flat,
    explode_snapshot,
    normalize_ticks,
    partition_keys,
    rejected,
    status_filter,
)
from tickloom.schemas import BATCH, FIELDS, WAREHOUSE

ZONE = "Asia/Seoul"
SETTINGS = list(
    itertools.product(("UTC", "Asia/Seoul", "America/New_York"), ("true", "false"))
)


@pytest.fixture(params=SETTINGS, ids=lambda pair: f"{pair[0]}-{pair[1]}")
def any_session(request, session_settings):
    zone, ansi = request.param
    session_settings(zone=zone, ansi=ansi)


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def envelope(data, status="0000"):
    return json.dumps({"status": status, "data": data})


def exploded(spark, *texts):
    return explode_snapshot(decode_envelope(lines(spark, *texts)))


def coins(df):
    return sorted((row.coin, row.timestamp) for row in accepted(df).collect())


def reasons(df):
    return sorted(row.reason for row in rejected(df).collect())


GOOD = {"AAA": {"opening_price": "1.0", "closing_price": "1.5"}, "date": "1636000000123"}


@pytest.mark.parametrize("status", ["0000", "0", "00", 0, "0.0", "0.4", " 0.", "-.7", 0.2])
def test_good_status(spark, any_session, status):
    assert coins(exploded(spark, envelope(GOOD, status))) == [("AAA", "1636000000123")]


@pytest.mark.parametrize("status", ["5600", "E1", "", None])
def test_other_status_is_kept_apart(spark, any_session, status):
    line = envelope(GOOD, status)
    rows = exploded(spark, line)
    assert coins(rows) == []
    assert [(r.reason, r.body, r.coin) for r in rejected(rows).collect()] == [
        ("status", line, None)
    ]


def test_status_filter_on_text(spark, any_session):
    df = spark.createDataFrame([("0",), ("0000",), ("E1",), (None,), ("5600",)], "status string")
    assert sorted(r.status for r in status_filter(df).collect()) == ["0", "0000"]


@pytest.mark.parametrize(
    "line, reason",
    [
        ("garbage", "status"),
        ("", "status"),
        ("{", "status"),
        (envelope(None), "payload"),
        (envelope([1]), "payload"),
        (envelope("text"), "payload"),
        ('{"status":"0000"}', "payload"),
        (envelope({"AAA": {"closing_price": "1"}}), "time"),
        (envelope({"AAA": {"closing_price": "1"}, "date": "abc"}), "time"),
        (envelope({"AAA": {"closing_price": "1"}, "date": None}), "time"),
        (envelope({"AAA": {"closing_price": "1"}, "date": "9223372036854775807"}), "time"),
        (envelope({"AAA": {"closing_price": "1"}, "date": "99999999999999999999"}), "time"),
        (envelope({}), "time"),
    ],
)
def test_bad_snapshot_is_one_reject_with_its_line(spark, any_session, line, reason):
    rows = exploded(spark, line)
    assert coins(rows) == []
    assert [(r.reason, r.body) for r in rejected(rows).collect()] == [(reason, line)]


def test_only_the_time_gives_no_rows(spark):
    assert exploded(spark, envelope({"date": "1"})).count() == 0


@pytest.mark.parametrize("bad", [5, "text", None, True, [1]])
def test_bad_instrument_does_not_hurt_its_neighbours(spark, any_session, bad):
    rows = exploded(spark, envelope({**GOOD, "BBB": bad}))
    assert coins(rows) == [("AAA", "1636000000123")]
    assert [(r.reason, r.coin) for r in rejected(rows).collect()] == [("instrument", "BBB")]


def test_instrument_without_fields_is_a_row(spark):
    row = accepted(exploded(spark, envelope({"AAA": {}, "date": "1636000000123"}))).first()
    assert row.coin == "AAA" and all(row[name] is None for name in FIELDS)


def test_unknown_and_reserved_names_inside_an_instrument(spark):
    data = {"AAA": {"coin": "ZZ", "timestamp": "9", "x": "1", "closing_price": "1"}, "date": "77"}
    row = accepted(exploded(spark, envelope(data))).first()
    assert (row.coin, row.timestamp, row.closing_price) == ("AAA", "77", "1")
    assert set(row.asDict()) == {"coin", "timestamp", *FIELDS}


def test_last_of_repeated_keys_wins(spark, any_session):
    line = (
        '{"status":"5600","status":"0000","data":{"a":{"closing_price":"1"},"date":"1",'
        '"b":{"closing_price":"7"},"a":{"closing_price":"2","closing_price":"3"},"date":"2"}}'
    )
    rows = accepted(exploded(spark, line)).collect()
    assert sorted((r.coin, r.timestamp, r.closing_price) for r in rows) == [
        ("a", "2", "3"),
        ("b", "2", "7"),
    ]


def test_number_and_boolean_fields(spark, any_session):
    data = {"AAA": {"closing_price": 2e-05, "opening_price": True, "max_price": "abc"}, "date": 1}
    row = normalize_ticks(accepted(exploded(spark, envelope(data))), ZONE).first()
    assert (row.closing_price, row.opening_price, row.max_price) == (2e-05, None, None)
    assert row.timestamp == "1970-01-01 09:00:00"


def test_other_columns_and_own_fields_are_carried(spark):
    df = lines(spark, envelope(GOOD)).withColumn("origin", F.lit("x"))
    row = accepted(explode_snapshot(decode_envelope(df), ("closing_price",))).first()
    assert row.asDict() == {
        "origin": "x", "coin": "AAA", "timestamp": "1636000000123", "closing_price": "1.5"
    }


def test_same_rows_as_a_plain_python_decoder(spark):
    texts = [
        envelope({f"C{j}": {"closing_price": str(i * j), "x": 1} for j in range(i)} | {"date": str(i)})
        for i in range(1, 30)
    ]
    expected = []
    for text in texts:
        data = json.loads(text)["data"]
        at = data.pop("date")
        expected += [(coin, at, item["closing_price"]) for coin, item in data.items()]
    rows = accepted(exploded(spark, *texts)).select("coin", "timestamp", "closing_price")
    assert sorted(map(tuple, rows.collect())) == sorted(expected)


def _random_text(rng):
    alphabet = ["a", "B", "9", ".", " ", '"', "\\", "/", "{", "}", ",", ":", "\t", "\n", "é", "한", "😀", "date"]
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6)))


def _random_snapshot(rng):
    """A snapshot as JSON text with repeated keys, and the rows it must give."""
    pairs, rows = [], {}
    at = str(rng.randint(0, 10**13))
    for _ in range(rng.randint(0, 6)):
        coin = rng.choice((_random_text(rng), "AAA", "BBB"))
        if coin == "date":
            continue
        fields = {
            "closing_price": rng.choice((_random_text(rng), "1.5", None)),
            _random_text(rng): rng.choice((1, None, {"closing_price": "7"}, ["x"])),
            "date": _random_text(rng),
        }
        pairs.append((coin, fields))
        rows[coin] = fields["closing_price"]
    pairs.insert(rng.randint(0, len(pairs)), ("date", at))
    body = ",".join(
        f"{json.dumps(key)}:{json.dumps(value, ensure_ascii=rng.random() < 0.5)}"
        for key, value in pairs
    )
    return f'{{"status":"0000","data":{{{body}}}}}', at, rows


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_random_snapshots(spark, session_settings, ansi):
    session_settings(ansi=ansi)
    rng = random.Random(7)
    snapshots = [_random_snapshot(rng) for _ in range(400)]
    df = spark.createDataFrame(
        [(i, text) for i, (text, _, _) in enumerate(snapshots)], "i int, value string"
    )
    rows = explode_snapshot(decode_envelope(df))
    assert rejected(rows).count() == 0
    got = sorted(
        (r.i, r.coin, r.timestamp, r.closing_price or "", r.closing_price is None)
        for r in accepted(rows).collect()
    )
    assert got == sorted(
        (i, coin, at, price or "", price is None)
        for i, (_, at, items) in enumerate(snapshots)
        for coin, price in items.items()
    )


@pytest.mark.parametrize(
    "ms, text",
    [
        ("1636000000123", "2021-11-04 13:26:40"),
        ("1636000000999", "2021-11-04 13:26:40"),
        ("1.636000000123E12", "2021-11-04 13:26:40"),
        ("1730613600000", "2024-11-03 15:00:00"),  # autumn switch in New York
        ("1710005400000", "2024-03-10 02:30:00"),  # an hour New York skips
        ("4102444800000", "2100-01-01 09:00:00"),
        ("abc", None),
        (None, None),
        ("9223372036854775807", None),
    ],
)
def test_civil_time_in_any_session(spark, any_session, ms, text):
    df = spark.createDataFrame([(ms,)], "ms string")
    wall = civil_time(seconds_from_millis(F.col("ms")), ZONE)
    row = df.select(civil_text(wall).alias("t"), civil_date(wall).cast("string").alias("d")).first()
    assert (row.t, row.d) == (text, text and text[:10])


@pytest.mark.parametrize("zone", ["Asia/Seoul", "America/New_York", "Europe/Dublin"])
def test_civil_time_against_convert_timezone(spark, any_session, zone):
    seconds = F.col("id") * 1777
    instants = spark.range(-1_000_000, 2_000_000, 1, 8).select(seconds.alias("s"))
    utc = F.timestamp_add("SECOND", F.col("s"), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    other = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    assert instants.where(~civil_time(F.col("s"), zone).eqNullSafe(other)).count() == 0


def test_day_and_hour_keys(spark, any_session):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 17, 30, 1),)], "ts timestamp_ntz")
    row = partition_keys(df, ZONE).first()
    assert (str(row.dt), row.dt_nodash, row.hh) == ("2024-03-10", "20240310", "02")


def test_flat_messages(spark, any_session):
    texts = [
        '{"coin":"A","date":"1636000000123","closing_price":"1.5","units_traded":{"x":1}}',
        "garbage",
        '{"coin":"B","date":1636000000123,"closing_price":2e-05}',
        '{"coin":"C","date":"163","closing_price":null}',
        '{"coin":"D","date":"abc"}',
    ]
    messages = lines(spark, *texts).select(F.col("value").cast("binary").alias("value"))
    flat = decode_flat(messages)
    assert flat.where("coin = 'A'").first().units_traded == '{"x":1}'
    rows = {r.coin: r for r in normalize_ticks(flat, ZONE, "warehouse").collect()}
    assert (rows["A"].date, rows["A"].timestamp) == ("2021-11-04 13:26:40", "1636000000")
    assert (rows["A"].closing_price, rows["A"].units_traded) == (1.5, None)
    assert (rows["B"].date, rows["B"].closing_price) == ("2021-11-04 13:26:40", 2e-05)
    assert (rows["C"].date, rows["C"].timestamp) == ("1970-01-01 09:02:43", "163")
    assert rows["D"].dt is None and rows[None].dt is None


def test_layouts(spark):
    rows = accepted(exploded(spark, envelope(GOOD)))
    batch = normalize_ticks(rows, ZONE)
    assert [(f.name, f.dataType) for f in batch.schema] == [(f.name, f.dataType) for f in BATCH]
    flat = decode_flat(lines(spark, '{"coin":"A"}'))
    warehouse = normalize_ticks(flat, ZONE, "warehouse")
    assert [(f.name, f.dataType) for f in warehouse.schema] == [
        (f.name, f.dataType) for f in WAREHOUSE
    ]
    with pytest.raises(ValueError):
        normalize_ticks(rows, ZONE, "other")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_keys_of_both_kinds_of_time_in_any_session(spark, session_settings, zone):
    session_settings(zone=zone)
    instants = spark.sql(
        "select timestamp_seconds(1636000000) as ts, timestamp_ntz'2021-11-04 04:26:40' as utc"
    )
    for column in ("ts", "utc"):
        row = partition_keys(instants, "Asia/Seoul", column).first()
        assert (str(row.dt), row.dt_nodash, row.hh) == ("2021-11-04", "20211104", "13")
    with pytest.raises(TypeError):
        partition_keys(spark.range(1), "UTC", "id")


def test_the_zone_is_looked_up_once_per_row(spark):
    rows = partition_keys(spark.sql("select timestamp_ntz'2021-11-04 04:26:40' as ts"), "Asia/Seoul")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "convert_timezone" not in plan
