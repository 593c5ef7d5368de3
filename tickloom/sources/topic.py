"""Message topics: the connector, or anything of the same shape."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.days import as_date
from tickloom.schemas import TOPIC


def _bounds(
    day: dt.date | str | None,
    zone: str | None,
    slack: dt.timedelta | None,
    late: dt.timedelta | None,
) -> tuple[dt.datetime | None, dt.datetime | None]:
    """The instants between which messages of the day arrive, each None if not bounded."""
    if slack is None and late is None:
        return None, None
    if day is None or zone is None:
        raise ValueError("slack and late need day and zone")
    first = as_date(day)
    midnights = (
        dt.datetime.combine(d, dt.time(), ZoneInfo(zone)).astimezone(dt.timezone.utc)
        for d in (first, first + dt.timedelta(days=1))
    )
    start, end = midnights
    return start - slack if slack is not None else None, end + late if late is not None else None


def topic_reader_options(
    options: dict[str, str],
    day: dt.date | str | None = None,
    zone: str | None = None,
    slack: dt.timedelta | None = None,
    late: dt.timedelta | None = None,
) -> dict[str, str]:
    """Connector options of a bounded read: earliest to latest by default, headers included.

    With `day`, `zone` and `slack` the read starts at the first message that arrived no earlier than
    `slack` before the day; with `late` it ends before the first one that arrived `late` after it.
    """
    bounded = {"includeHeaders": "true", **options}
    start, end = _bounds(day, zone, slack, late)
    if start is not None:
        bounded["startingTimestamp"] = str(int(start.timestamp() * 1000))
        # A partition without a message that late has nothing for the day.
        bounded.setdefault("startingOffsetsByTimestampStrategy", "latest")
    if end is not None:
        # A partition without a message that late is read to its end.
        bounded["endingTimestamp"] = str(int(end.timestamp() * 1000))
    return bounded


def read_topic(
    spark: SparkSession,
    source: str | dict[str, str],
    day: dt.date | str | None = None,
    zone: str | None = None,
    slack: dt.timedelta | None = None,
    late: dt.timedelta | None = None,
) -> DataFrame:
    """Messages of a topic.

    `source` is a dict of connector options (bootstrap servers, subscription) or
    the path of a parquet table of the same shape. Without `slack` and `late` the
    whole topic is read. They say how far a message's broker time may lie before
    its event time, and after it; messages outside are skipped at the source, by
    offset or by row group, so a bound that does not hold loses rows of the day.
    The exact day is cut from the payload later (`day_slice`).
    """
    if isinstance(source, dict):
        options = topic_reader_options(source, day, zone, slack, late)
        return spark.read.format("kafka").options(**options).load()
    messages = spark.read.schema(TOPIC).parquet(source)
    start, end = _bounds(day, zone, slack, late)
    if start is not None:
        messages = messages.where(F.col("timestamp") >= F.lit(start))
    if end is not None:
        messages = messages.where(F.col("timestamp") < F.lit(end))
    return messages
