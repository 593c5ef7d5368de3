import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.llm.helpers import AWKWARD, awkward, empty
from tickloom.llm.resampling import LONG_FEATURE, crc32_all, draw, importance


@given(st.lists(st.binary(max_size=40), max_size=60))
def test_matrices_give_the_crc32_of_every_feature(features):
    assert crc32_all(features).tolist() == [zlib.crc32(f) for f in features]


def test_features_around_the_longest_matrix_row():
    features = [b"x" * n for n in (LONG_FEATURE - 1, LONG_FEATURE, LONG_FEATURE + 1, 0)] + ["ß".encode()] * 3
    assert crc32_all(features).tolist() == [zlib.crc32(f) for f in features]


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_features(text, n):
    words = plain_words(text)
    return [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, n, buckets, percent, least):
    """doc_id, n_features, weight, score, rank of (doc_id, text) rows, by loops and zlib."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    held = [[bucket(f) for f in plain_features(text, n)] for _, text in rows]
    s = Counter(b for row in held for b in row)
    t = Counter(bucket(f) for text in target for f in plain_features(text, n))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))
    )
    out = []
    for (i, text), row in zip(rows, held):
        weight = sum(map(gain, row))
        key = f"2024:{'' if i is None else i}".encode()
        h = int(hashlib.sha256(key).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(row), weight, weight + noise, len(plain_words(text)) >= least))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: percent * len(able) // 100]
    ranks = Counter((r[:4], k) for k, r in enumerate(drawn, 1))
    ranks.update((r[:4], None) for r in out if not r[4])
    ranks.update((r[:4], None) for r in able[len(drawn) :])
    return ranks


def got(df):
    return Counter(((r.doc_id, r.n_features, r.weight, r.score), r["rank"]) for r in df.collect())


@pytest.mark.parametrize("n, buckets, percent, least", [(1, 10_000, 10, 20), (2, 7, 50, 1), (3, 100, 100, 0), (1, 50, 0, 0)])
def test_equals_the_plain_version_on_awkward_rows(spark, n, buckets, percent, least):
    rows = [(i, t) for i, t, *_ in AWKWARD]
    target = ["Some words of a text", None, "", "漢字 thin line"]
    aimed = spark.createDataFrame([(t,) for t in target], "text string")
    out = importance(awkward(spark), aimed, n=n, buckets=buckets, percent=percent, least_words=least)
    assert got(out) == brute(rows, target, n, buckets, percent, least)


def test_many_rows_without_id_rank_without_gaps(spark):
    docs = spark.range(3000).selectExpr("cast(null as long) doc_id", "repeat('same ', 30) text")
    out = importance(docs, docs.limit(1), percent=50).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 1501)) and len(out) == 3000


def test_empty_tables(spark):
    none = empty(spark)
    assert importance(none, none).count() == 0
    docs = awkward(spark)
    assert importance(docs, none).count() == len(AWKWARD)
    assert importance(none, docs).columns == ["row", "doc_id", "n_words", "n_features", "weight", "score", "rank"]


def test_draw_keeps_columns_and_rows(spark):
    docs = awkward(spark)
    out = draw(docs, docs, percent=100, least_words=0)
    assert out.columns == docs.columns and out.count() == len(AWKWARD)
    assert draw(docs, docs, percent=30, least_words=0).count() == len(AWKWARD) * 30 // 100


def test_blocks_of_texts_join_up(spark, monkeypatch):
    from tickloom.llm import resampling

    texts = [t.encode() for t in ("a b c", "", "d e", "a a a a", "f")]
    whole = list(resampling._bucketed(texts, 2, 97))
    monkeypatch.setattr(resampling, "BLOCK", 3)
    parts = list(resampling._bucketed(texts, 2, 97))
    assert len(parts) > 1 and [n for p in parts for n in p[0]] == whole[0][0]
    assert np.concatenate([p[2] for p in parts]).tolist() == whole[0][2].tolist()
