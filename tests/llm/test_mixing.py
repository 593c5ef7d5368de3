import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, SF_DIR, awkward, empty, words
from tickloom.llm.mixing import mix, source_targets, with_copies


def shared(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, total, full = {}, sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        if not open_:
            return {s: 3.0 * sizes[s] for s in full}
        each = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if each * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] for s in full} | {s: each * weight[s] for s in open_}
        full |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 5, None: 3, "d": 0},
        {"a": 7},
        {f"s{i:02}": i * i % 37 for i in range(40)},
        {"x": 1, "y": 1, "z": 1_000_000},
    ],
)
def test_targets_are_where_sharing_again_comes_to_rest(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = shared(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def plain(rows):
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    target = shared(sizes)
    out = []
    for id_, text, _, source in rows:
        n = len(words(text))
        rate = target[source] / sizes[source] if sizes[source] else 0.0
        digest = hashlib.md5((text or "").encode()).hexdigest()
        key = f"mix-1:{'' if id_ is None else id_}:{digest}".encode()
        coin = int(hashlib.md5(key).hexdigest()[:13], 16) / 16**13
        out.append((id_, n, int(rate) + (coin < rate - int(rate))))
    return sorted(out, key=str)


def test_copies_match_a_plain_version(spark):
    counted, names = with_copies(awkward(spark))
    rows = counted.select("doc_id", names["size"], names["copies"]).collect()
    assert sorted((tuple(r) for r in rows), key=str) == plain(AWKWARD)
    assert names["size"] != "size" and names["copies"] != "copies"


def test_the_mix_repeats_rows_and_keeps_columns(spark):
    docs = awkward(spark)
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(n for _, _, n in plain(AWKWARD))


def test_sources_come_near_their_targets(spark):
    """Within four standard deviations of the coins; all together within a fiftieth."""
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.1')}/documents.parquet")
    counted, _ = with_copies(docs)
    part = "(target / source_size - floor(target / source_size))"
    rows = counted.selectExpr(
        "source", "size * copies as taken", "target", "copies", f"size * size * {part} * (1 - {part}) as variance"
    ).groupBy("source").agg({"taken": "sum", "target": "max", "copies": "max", "variance": "sum"}).collect()
    assert len(rows) == docs.select("source").distinct().count()
    for r in rows:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 4 * r["sum(variance)"] ** 0.5 and r["max(copies)"] <= 3
    total = sum(r["max(target)"] for r in rows)
    assert abs(sum(r["sum(taken)"] for r in rows) - total) < 0.02 * total


@pytest.mark.parametrize("id_", ["cast(null as long)", "7L"])
def test_sources_come_near_their_targets_without_ids(spark, id_):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").selectExpr(f"{id_} as doc_id", "text", "source")
    counted, _ = with_copies(docs)
    part = "(target / source_size - floor(target / source_size))"
    # Rows of one text share a coin.
    groups = counted.groupBy("source", "text").agg(
        F.sum("size").alias("size"), F.max("copies").alias("copies"), F.max("target").alias("target"),
        F.max("source_size").alias("source_size"),
    )
    rows = groups.selectExpr(
        "source", "size * copies as taken", "target", f"size * size * {part} * (1 - {part}) as variance"
    ).groupBy("source").agg({"taken": "sum", "target": "max", "variance": "sum"}).collect()
    for r in rows:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 4 * r["sum(variance)"] ** 0.5 + 1


def test_nothing_to_mix(spark):
    assert mix(empty(spark)).count() == 0
    silent = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert mix(silent).count() == 0


def test_plan_has_no_python(spark):
    plan = mix(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
