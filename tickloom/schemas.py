"""Column names, column orders and schemas of the tick data."""

from __future__ import annotations

from pyspark.sql import types as T

# The JSON fields of one instrument.
FIELDS = (
    "acc_trade_value",
    "acc_trade_value_24H",
    "closing_price",
    "fluctate_24H",
    "fluctate_rate_24H",
    "max_price",
    "min_price",
    "opening_price",
    "prev_closing_price",
    "units_traded",
    "units_traded_24H",
)

# The payload key that holds the snapshot time, not an instrument.
TIME_KEY = "date"

# Measure order of the batch table (after coin, timestamp).
BATCH_MEASURES = (
    "opening_price",
    "closing_price",
    "min_price",
    "max_price",
    "units_traded",
    "acc_trade_value",
    "prev_closing_price",
    "units_traded_24H",
    "acc_trade_value_24H",
    "fluctate_24H",
    "fluctate_rate_24H",
)

# Measure order of the warehouse table (after coin, date, timestamp).
WAREHOUSE_MEASURES = (
    "opening_price",
    "closing_price",
    "max_price",
    "min_price",
    "prev_closing_price",
    "fluctate_24H",
    "fluctate_rate_24H",
    "acc_trade_value",
    "acc_trade_value_24H",
    "units_traded",
    "units_traded_24H",
)


def _table(texts: tuple[str, ...], measures: tuple[str, ...]) -> T.StructType:
    schema = T.StructType()
    for name in texts:
        schema = schema.add(name, T.StringType())
    for name in measures:
        schema = schema.add(name, T.DoubleType())
    return schema.add("dt", T.DateType())


# `timestamp` is civil text in the batch table and epoch seconds in the
# warehouse table, whose civil text is `date`.
BATCH = _table(("coin", "timestamp"), BATCH_MEASURES)
WAREHOUSE = _table(("coin", "date", "timestamp"), WAREHOUSE_MEASURES)

# Rejected lines and instruments, by the day their line landed on. `digest` is the SHA-256 of the
# body, `landed` the hour the line landed in, where its path tells.
QUARANTINE = (
    T.StructType()
    .add("reason", T.StringType())
    .add("coin", T.StringType())
    .add("body", T.StringType())
    .add("digest", T.StringType())
    .add("landed", T.IntegerType())
    .add("dt", T.DateType())
)
# What tells rejects apart.
QUARANTINE_KEY = ("reason", "coin", "digest", "landed", "dt")

ENVELOPE = "status string, data map<string,string>"

TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]
                )
            ),
        ),
    ]
)
