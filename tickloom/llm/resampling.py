"""Importance resampling of documents towards a target distribution, over hashed features.

A text's words are runs of ASCII letters, digits and other characters beyond ASCII, with A-Z in
lower case; its features are all runs of 1 to `n` consecutive words, repeats included. A feature's
bucket is the crc32 of its bytes modulo `buckets`. A bucket's gain is the log ratio of its smoothed
shares in target and documents, in thousandths, rounded down; a document's weight is the sum of its
features' gains. Its score adds Gumbel noise seeded by its id, so that the highest scores are a draw
without replacement with probabilities by weight. Of the documents with `least_words` words or more,
`percent` in a hundred are drawn.

All crc32 values of a block of texts are worked out together: its distinct features are grouped by
length into matrices of bytes, every row a feature; each step updates the crc32 of all rows by one
column, and the buckets are scattered back to where the features stand. A matrix of features of more
than `LONG_FEATURE` bytes would be a loop over bytes, so those few go through zlib, to the same value.

Defined cases: a null text has no words, and a text without words weighs 0; a null id draws its noise
from the empty text; equal scores go to the smaller id, a null id last, and rows of one id and score in
any order; no documents, or none long enough, draw none; an empty target has no features. Only id
and text are read, so other columns may have any names.

Every text is read once. Its buckets are written, a few bits a word; counts of buckets collapse before
their shuffle, and only they, `buckets` rows, come to the driver. Ranks come from a range shuffle of
three numbers a document: equal scores part by id and row, so no score is a hot task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import free_names, text_or_empty, written

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG_FEATURE = 4096
#: Features of texts whose crc32 values are worked out together; one text is never divided.
BLOCK = 1 << 20
SEED = "2024"
#: The bits of `monotonically_increasing_id` that count the rows of one task.
_LOCAL = 33


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def crc32_all(features: list[bytes]) -> np.ndarray:
    """The unsigned crc32 of every feature, matrix by matrix of equal lengths."""
    out = np.empty(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    starts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for rows in np.split(order, starts[1:]) if len(order) else []:
        length = int(lengths[rows[0]])
        if length > LONG_FEATURE:
            out[rows] = [zlib.crc32(features[i]) for i in rows]
            continue
        joined = b"".join([features[i] for i in rows])
        matrix = np.frombuffer(joined, np.uint8).reshape(len(rows), length)
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(matrix.T):
            crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
        out[rows] = ~crc
    return out


def words_of(text: bytes) -> list[bytes]:
    # bytes.lower changes A-Z alone.
    return _WORD.findall(text.lower())


def features_of(words: list[bytes], n: int) -> list[bytes]:
    runs = list(words)
    for k in range(2, n + 1):
        runs += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    return runs


def _bucketed(texts: list[bytes], n: int, buckets: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Words of each text, ends of its features, and their buckets, for blocks of texts."""
    index: dict[bytes, int] = {}
    n_words, ends, ids = [], [], []

    def block():
        codes = crc32_all(list(index)) % np.uint32(buckets)
        return n_words, np.array([0, *ends], np.int64), codes.astype(np.int32)[np.array(ids, np.int64)]

    for text in texts:
        words = words_of(text)
        ids += [index.setdefault(f, len(index)) for f in features_of(words, n)]
        n_words.append(len(words))
        ends.append(len(ids))
        if len(ids) >= BLOCK:
            yield block()
            index, n_words, ends, ids = {}, [], [], []
    if n_words:
        yield block()


def bucket_table(
    docs: DataFrame, n: int, buckets: int, id: str = "doc_id", text: str = "text", row: str | None = None
) -> DataFrame:
    """row, doc_id, n_words, buckets (of every feature, in order) of every row; `row` is unique."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column("content").to_pylist(), 0
            for n_words, ends, codes in _bucketed(texts, n, buckets):
                here = batch.slice(at, len(n_words))
                at += len(n_words)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes, pa.int32()))
                columns = [here.column("row"), here.column("doc_id"), pa.array(n_words, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "buckets"])

    rows = docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        F.col(id).alias("doc_id"),
        text_or_empty(text).cast("binary").alias("content"),
    )
    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, doc_id {kind}, n_words long, buckets array<int>")


def bucket_counts(table: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket: `buckets` numbers."""
    counted = table.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count()
    out = np.zeros(buckets)
    for row in counted.collect():
        out[row["bucket"]] = row["count"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier a bucket is in the target, rounded down."""
    size = len(source)
    likelier = (target + 1) * (source.sum() + size) / ((source + 1) * (target.sum() + size))
    return np.floor(1000 * np.log(likelier)).astype(np.int64)


def _weighed(table: DataFrame, gain: np.ndarray) -> DataFrame:
    """row, doc_id, n_words, n_features, weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            ends = lists.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[lists.flatten().to_numpy(zero_copy_only=False)])])
            ends -= ends[0]
            columns = [batch.column(name) for name in ("row", "doc_id", "n_words")]
            columns += [pa.array(np.diff(ends)), pa.array(np.diff(sums[ends]).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "n_features", "weight"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.mapInArrow(run, f"row long, doc_id {kind}, n_words long, n_features long, weight long")


def noise(seed: str, id: str = "doc_id") -> Column:
    """Gumbel noise in thousandths, by the first 32 bits of a hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def importance(
    docs: DataFrame,
    target: DataFrame,
    n: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: str = SEED,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    row: str | None = None,
) -> DataFrame:
    """row, doc_id, n_words, n_features, weight, score, rank of every row of `docs`; undrawn ones have no rank.

    `row` is the column of that name in `docs` that numbers them, or a number given here.
    """
    table = written(bucket_table(docs, n, buckets, id, text, row), "buckets")
    aimed = bucket_table(target.select(F.lit(0).alias("id"), F.col(target_text).alias("text")), n, buckets, "id")
    gain = gains(bucket_counts(table, buckets), bucket_counts(aimed, buckets))
    scored = _weighed(table, gain).select("*", (F.col("weight") + noise(seed)).alias("score"))
    scored = written(scored, "scores")
    in_order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    able = scored.where(F.col("n_words") >= least_words)
    sorted_ = able.repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    # Counts the rows of a task in its upper bits' order, so ranks need no window over all rows.
    placed = written(sorted_.select("*", F.monotonically_increasing_id().alias("place")), "places")
    task = F.shiftright("place", _LOCAL)
    local = F.col("place").bitwiseAND((1 << _LOCAL) - 1)
    tasks = placed.groupBy(task.alias("task")).agg((F.max(local) + 1).alias("held"))
    # A row per task of the shuffle above.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select(
        "task",
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
        F.expr(f"(sum(held) over ()) * {int(percent)} div 100").alias("drawn"),
    )
    ranked = placed.join(tasks, task == tasks["task"]).select(
        *scored.columns, F.when((rank := F.col("before") + local + 1) <= F.col("drawn"), rank).alias("rank")
    )
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of `docs`, with all their columns; options as for `importance`."""
    (row,) = free_names(docs, "row_number")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    drawn = importance(numbered, target, row=row, **options).where("rank is not null")
    return numbered.join(drawn.select(F.col("row").alias(row)), row, "left_semi").select(*docs.columns)
