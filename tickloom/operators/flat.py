"""Flat JSON messages to text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import FIELDS, TIME_KEY


def decode_flat(
    messages: DataFrame,
    fields: tuple[str, ...] = (*FIELDS, "coin", TIME_KEY),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per message, every field as text; null where missing or not JSON.

    `keep` names columns of the message to carry along.
    """
    text = F.col("value").cast("string")
    return messages.select(*keep, F.json_tuple(text, *fields).alias(*fields))
