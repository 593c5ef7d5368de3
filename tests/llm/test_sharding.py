import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, SF_DIR, awkward, empty
from tickloom.llm import sharding
from tickloom.llm.sharding import keyed_rows, shard_rows, splitters


def check(rows, expected, shards):
    assert len(rows) == expected
    total = sum(r.size for r in rows)
    largest = max(r.size for r in rows)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) <= set(range(shards))
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= largest


def test_sizes_slots_and_digests(spark):
    rows = shard_rows(awkward(spark)).collect()
    check(rows, len(AWKWARD), 8)
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in AWKWARD)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


@pytest.mark.parametrize("ranges,per_range", [(256, 10**6), (16, 10), (1, 10**6)])
def test_all_shards_are_as_large_whatever_the_ranges(spark, ranges, per_range):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = shard_rows(docs, least_ranges=ranges, rows_per_range=per_range).collect()
    check(rows, docs.count(), 8)


def test_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    one, two = (sorted((r.doc_id, r.shard, r.slot) for r in shard_rows(docs.repartition(n)).collect()) for n in (1, 5))
    assert one == two


def test_a_group_of_copies_with_a_third_of_all_rows_is_cut(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES", 2)
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "copy " * 20).otherwise(F.concat(F.lit("text "), "id")).alias("text"),
    )
    rows = keyed_rows(docs).cache()
    bounds = splitters(rows, 50, 10**6)
    held = rows.withColumn("range", sharding._range_of(bounds)).groupBy("range").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")
    ).collect()
    mean_bytes, mean_rows = sum(r.bytes for r in held) / 50, 6000 / 50
    assert all(r.bytes <= sharding.OVERFULL * mean_bytes and r.n <= sharding.OVERFULL * mean_rows for r in held)
    check(shard_rows(docs).collect(), 6000, 8)


def test_one_row_repeated_and_no_rows(spark):
    same = spark.createDataFrame([(1, "x")] * 50, "doc_id long, text string")
    check(shard_rows(same, least_ranges=4).collect(), 50, 8)
    assert shard_rows(empty(spark)).count() == 0
