"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, ranges, shards.

The key of a row is (hash of its text, id): equal texts lie next to each other, and a group of
copies of any size can still be cut. The law is `bytes`: the rows lie in key order, and shard s of
n takes the rows whose middle byte falls into the s-th n-th of all bytes. So shards differ from the
ideal by less than one row at either end, whatever the sample was; the sample only makes the
ranges, which are the tasks, even.

A row is drawn with a probability in proportion to its size, by a hash of its key, so reruns agree.
The weighted quantiles of the sample are the boundaries; ranges that turn out larger than
`OVERFULL` times the mean, in bytes or rows, are divided again by a denser sample of their own.
Only a range that holds one key stays as it is. The driver sees boundaries and totals per range,
never more than a few for every `rows_per_range` rows.

Defined cases: a null text has size 1, like an empty one, for a size is the text's bytes plus 1; a
null id comes first; rows with equal id and text follow each other in any order, and have the same
values in all other columns of the result; no rows give an empty result. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import text_or_empty, written

LAW = "bytes"
SHARDS = 8
#: Expected samples per range, and how much above the mean a range may be.
SAMPLES, OVERFULL = 48, 2.0
#: Least number of ranges, and rows of a range where there are more.
LEAST_RANGES, ROWS_PER_RANGE = 256, 1_000_000

Key = tuple[int, int]
NO_ID = -(2**63)


def keyed_rows(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the key (k1, k2)."""
    content = text_or_empty(text)
    return docs.select(
        F.col(id).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(content).alias("k1"),
        F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("k2"),
    )


def _range_of(bounds: list[Key]):
    """A column of the number of boundaries at or below a key."""
    firsts = np.array([k1 for k1, _ in bounds], dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(k1: pd.Series, k2: pd.Series) -> pd.Series:
        a, b = k1.to_numpy(), k2.to_numpy()
        low = np.searchsorted(firsts, a, "left")
        high = np.searchsorted(firsts, a, "right")
        for i in np.flatnonzero(low < high):  # the first part of the key is that of a boundary
            low[i] = bisect_left(bounds, (a[i], b[i] + 1), low[i], high[i])
        return pd.Series(low.astype(np.int32))

    return range_of("k1", "k2")


def _drawn(rows: DataFrame, per_byte: float, salt: int) -> list[tuple[Key, float]]:
    """Keys drawn with probability size * per_byte, 1 at most, and the bytes that each stands for."""
    coin = F.pmod(F.xxhash64("k1", "k2", F.lit(salt)), F.lit(1 << 52)).cast("double") / float(1 << 52)
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(per_byte))
    found = rows.where(coin < chance).groupBy("k1", "k2").agg(F.sum(F.col("size") / chance).alias("w"))
    return sorted(((r.k1, r.k2), r.w) for r in found.collect())


def _quantiles(drawn: list[tuple[Key, float]], pieces: int) -> list[Key]:
    """The keys that cut the drawn weight into about equal pieces."""
    keys, weights = [k for k, _ in drawn], np.cumsum([w for _, w in drawn])
    if pieces < 2 or not keys:
        return []
    cuts = np.searchsorted(weights, weights[-1] * np.arange(1, pieces) / pieces)
    return sorted({keys[i] for i in cuts})


def splitters(rows: DataFrame, least: int, rows_per_range: int) -> list[Key]:
    """Boundaries between ranges of the keyed rows: a key at or above boundary i is in range i + 1."""
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not count:
        return []
    pieces = max(least, -(-count // rows_per_range))
    per_byte = pieces * SAMPLES / total
    bounds = _quantiles(_drawn(rows, per_byte, 0), pieces)
    salt = 0
    while bounds:
        salt += 1
        per_byte *= 4
        ranged = rows.withColumn("range", _range_of(bounds))
        held = ranged.groupBy("range").agg(
            F.sum("size").alias("bytes"),
            F.count(F.lit(1)).alias("rows"),
            (F.min(F.struct("k1", "k2")) != F.max(F.struct("k1", "k2"))).alias("divisible"),
        )
        limits = OVERFULL * total / pieces, OVERFULL * count / pieces
        full = held.where(
            F.col("divisible") & (F.col("rows") > 1)
            & ((F.col("bytes") > limits[0]) | (F.col("rows") > limits[1]))
        ).select("range", "bytes", "rows").collect()
        if not full:
            break
        over = {r.range: max(2, int(np.ceil(2 * max(r.bytes / limits[0], r.rows / limits[1])))) for r in full}
        inside = ranged.where(F.col("range").isin(list(over)))
        # Each row alike: a range may be overfull by the number of its rows.
        drawn = _drawn(inside, per_byte, salt)
        keys = [k for k, _ in drawn]
        new: set[Key] = set()
        for number, parts in over.items():
            first = bisect_right(keys, bounds[number - 1]) if number else 0
            end = bisect_left(keys, bounds[number]) if number < len(bounds) else len(keys)
            new |= set(_quantiles(drawn[first:end], parts))
        if not new - set(bounds) and per_byte >= 1:
            break
        bounds = sorted({*bounds, *new})
    return bounds


def shard_rows(
    docs: DataFrame,
    shards: int = SHARDS,
    id: str = "doc_id",
    text: str = "text",
    least_ranges: int = LEAST_RANGES,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of `docs`."""
    rows = written(keyed_rows(docs, id, text), "shard-keys")
    bounds = splitters(rows, least_ranges, rows_per_range)
    ranged = written(rows.withColumn("range", _range_of(bounds)), "shard-ranges")
    spark = docs.sparkSession
    held = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before, total = [], 0
    for r in sorted(held.collect()):
        before.append((r.range, total))
        total += r.bytes
    starts = spark.createDataFrame(before, "range int, before long")
    within = Window.partitionBy("range").orderBy("k1", "k2")
    placed = ranged.join(starts, "range").select(
        "*",
        (F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))).alias("passed"),
        F.row_number().over(within).alias("nth"),
    )
    # Twice the middle byte, so that all stays whole.
    middle = 2 * (F.col("before") + F.coalesce("passed", F.lit(0))) + F.col("size")
    shard = F.least(
        F.floor(middle.cast("decimal(38, 0)") * shards / F.lit(max(1, 2 * total)).cast("decimal(38, 0)")),
        F.lit(shards - 1),
    ).cast("int")
    placed = written(
        placed.select("doc_id", "size", "text_crc32", "range", "nth", shard.alias("shard")), "shard-places"
    )
    parts = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    slots, filled = [], {}
    for r in sorted((r.shard, r.range, r.n, r.first) for r in parts.collect()):
        number, range_, n, first = r
        slots.append((number, range_, filled.get(number, 0) - first))
        filled[number] = filled.get(number, 0) + n
    offsets = spark.createDataFrame(slots, "shard int, range int, offset long")
    return placed.join(offsets, ["shard", "range"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("nth") + F.col("offset")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
