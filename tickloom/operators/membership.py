"""A Bloom filter as columns: which rows may have a partner in another table, told before any shuffle.

The filter's bits are built by an aggregate over the small side and reach the scan of the large side as
the value of a scalar subquery, as Spark's own runtime filters do. A row with a partner always passes;
of the others about one in a hundred does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ROW, PROBES = 12, 3
# Eight megabytes, the most that goes to every task: some five million rows.
MAX_BITS = 1 << 26
_WORD = 6  # a word has 2^6 bits


def filter_bits(rows: int) -> int | None:
    """The size of a filter for so many rows, or None where it would be too large to send."""
    bits = 1 << max(_WORD, (rows * BITS_PER_ROW - 1).bit_length())
    return bits if bits <= MAX_BITS else None


def _places(key: Sequence[str], bits: int) -> list[Column]:
    """The bits of a row. Equal rows have equal ones, also with nulls, NaN and signed zeros."""
    mixed = F.xxhash64(*key)
    low, high = mixed.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(mixed, 32)
    step = high.bitwiseOR(F.lit(1))
    return [(low + step * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


def _bit(place: Column) -> Column:
    inside = place.bitwiseAND(F.lit((1 << _WORD) - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), inside)


def may_be_in(small: DataFrame, key: Sequence[str], rows: int) -> Column | None:
    """A condition for tables with the columns `key`: false only for rows without a partner in `small`.

    `rows` is the number of rows of `small`, or more; None where a filter for them would be too large.
    """
    bits = filter_bits(rows)
    if bits is None:
        return None
    set_ = small.select(F.explode(F.array(*_places(key, bits))).alias("place")).select(
        F.shiftright("place", _WORD).alias("word"), _bit(F.col("place")).alias("bits")
    )
    none = small.sparkSession.range(bits >> _WORD).select(
        F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")
    )
    words = set_.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    whole = words.agg(F.transform(in_order, lambda word: word["bits"]).alias("bits")).scalar()
    found = F.lit(True)
    for place in _places(key, bits):
        word = F.get(whole, F.shiftright(place, _WORD).cast("int"))
        found = found & (word.bitwiseAND(_bit(place)) != 0)
    return found
