"""Status-wrapped JSON snapshots to one row per instrument, without Python rows.

A bad snapshot or instrument does not stop the job. It stays in the result as a
row with a `reason`, so one pass over the raw text gives both the good rows
(`accepted`) and the rest (`rejected`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import in_calendar, last_wins, seconds_from_millis, whole_number
from tickloom.schemas import ENVELOPE, FIELDS, TIME_KEY

BAD_STATUS = "status"
BAD_PAYLOAD = "payload"
BAD_INSTRUMENT = "instrument"
BAD_TIME = "time"


def _status_ok(status: Column, ok_status: int) -> Column:
    # Numeric: "0000", "0" and "0.0" are the same code, "E1" and null are none.
    return F.coalesce(whole_number(status) == F.lit(ok_status), F.lit(False))


def status_filter(df: DataFrame, ok_status: int = 0, column: str = "status") -> DataFrame:
    """Rows whose status text is the number `ok_status`."""
    return df.where(_status_ok(F.col(column), ok_status))


def decode_envelope(
    lines: DataFrame, ok_status: int = 0, reserved: str = TIME_KEY
) -> DataFrame:
    """Raw lines (`value`) to `status`, `timestamp`, `payload` and `reason`.

    `payload` maps each key to its JSON text, `timestamp` is the snapshot's epoch
    text, found under the key `reserved`. `reason` is null for a good snapshot, `status` for a line that is no
    JSON or has another status, `payload` for a good status without an object,
    `time` for a payload without a usable snapshot time.
    """
    others = [name for name in lines.columns if name != "value"]
    parsed = (
        lines.withColumn("_envelope", F.from_json("value", ENVELOPE))
        .select(
            *others,
            "value",
            F.col("_envelope.status").alias("status"),
            last_wins(F.col("_envelope.data")).alias("payload"),
        )
        .withColumn("timestamp", F.col("payload").getItem(reserved))
    )
    seconds = seconds_from_millis(F.col("timestamp"))
    return parsed.withColumn(
        "reason",
        F.when(~_status_ok(F.col("status"), ok_status), F.lit(BAD_STATUS))
        .when(F.col("payload").isNull(), F.lit(BAD_PAYLOAD))
        .when(in_calendar(seconds).isNull(), F.lit(BAD_TIME)),
    )


def explode_snapshot(
    snapshots: DataFrame, fields: tuple[str, ...] = FIELDS, reserved: str = TIME_KEY
) -> DataFrame:
    """Decoded snapshots to one row per instrument.

    Gives the columns that came with the lines, then `coin`, `timestamp` (the
    snapshot's epoch text), the fields as text, `reason`, and `body`: the raw
    text of a rejected snapshot or instrument, null otherwise.
    """
    own = {"value", "status", "timestamp", "payload", "reason"}
    others = [name for name in snapshots.columns if name not in own]
    # A rejected snapshot becomes one row that holds its line.
    whole_line = F.create_map(F.lit(""), F.col("value"))
    rows = snapshots.select(
        *others,
        "timestamp",
        F.col("reason").alias("_reason"),
        F.explode(F.when(F.col("reason").isNull(), F.col("payload")).otherwise(whole_line)).alias(
            "_key", "_text"
        ),
    ).where(F.col("_key") != reserved)
    is_object = F.coalesce(F.startswith("_text", F.lit("{")), F.lit(False))
    # One expression over a generated column: a filter on it stays above the
    # generator. Below it, every line would be parsed once more.
    reason = F.coalesce("_reason", F.when(~is_object, F.lit(BAD_INSTRUMENT)))
    schema = ", ".join(f"`{name}` string" for name in fields)
    return rows.withColumn("_fields", F.from_json("_text", schema)).select(
        *others,
        F.when(F.col("_reason").isNull(), F.col("_key")).alias("coin"),
        "timestamp",
        *[F.col("_fields").getField(name).alias(name) for name in fields],
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("_text")).alias("body"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    """The good rows, without the columns that describe rejects."""
    return rows.where(F.col("reason").isNull()).drop("reason", "body")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNotNull())
