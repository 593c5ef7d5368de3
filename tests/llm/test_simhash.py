import random

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import AWKWARD, SF_DIR, awkward, empty, words
from tickloom.llm.graph import components
from tickloom.llm.simhash import drop_near_copies, fingerprint, near_groups, near_links


def plain_fingerprint(text):
    w = words(text)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def roots(values, bits):
    """The smallest value that each reaches by steps of at most `bits` differing bits."""
    values = sorted(set(values))
    array = np.array(values, np.int64).view(np.uint64)
    parent = {x: x for x in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= bits):
            a, b = find(x), find(values[j])
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in values}


def test_fingerprints_match_a_plain_version():
    for _, text, *_ in AWKWARD:
        if len(text or "") < 10_000:
            assert fingerprint(text or "") == signed(plain_fingerprint(text))
    assert fingerprint("") == 0


@pytest.mark.parametrize("bits,block", [(3, 2048), (3, 3), (1, 2048), (4, 5)])
def test_no_link_is_lost(spark, bits, block):
    pick = random.Random(bits)
    values = []
    for _ in range(25):
        x = pick.getrandbits(64)
        for _ in range(pick.randint(1, 25)):
            y = x
            for _ in range(pick.randint(0, bits + 1)):
                y ^= 1 << pick.randrange(64)
            values.append(signed(y))
            x = y if pick.random() < 0.3 else x
    values += [0, 1, -1]
    nodes = spark.createDataFrame([(v,) for v in set(values)], "fp long")
    got = {r.node: r.root for r in components(near_links(nodes, bits, block)).collect()}
    want = roots(values, bits)
    linked = {x for x in want if want[x] != x} | {want[x] for x in want if want[x] != x}
    assert got == {x: want[x] for x in linked}


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(300, 340)] + [(5, 5), (9, 8), (8, 9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {x: 7 for x in [7, *range(300, 340)]} | {8: 8, 9: 8}
    assert got == want


def test_groups_match_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    root = roots([signed(f) for f in prints.values()], 3)
    members = {}
    for i, f in prints.items():
        members.setdefault(root[signed(f)], []).append(i)
    rows = near_groups(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == min(members[root[signed(prints[r.doc_id])]])


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = sorted(((r.doc_id, r.component_id) for r in near_groups(docs).collect()), key=str)
    assert len(got) == len(AWKWARD)
    assert [c for i, c in got if i in (2, 3, 4)] == [2, 2, 2]
    assert [c for i, c in got if i in (1, 5, 6)] == [1, 1, 1, 1]
    assert [c for i, c in got if i is None] == [None]
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {1, 2, 7, 8, None} <= {r.doc_id for r in kept.collect()} and kept.where("doc_id in (3, 4, 5, 6)").count() == 0


def test_no_documents(spark):
    assert near_groups(empty(spark)).count() == 0 == drop_near_copies(empty(spark)).count()


def test_one_row_of_each_component_stays_whatever_its_ids(spark):
    a = " ".join(f"alpha{i}" for i in range(300))
    b = " ".join(f"beta{i}" for i in range(300))
    c = " ".join(f"gamma{i}" for i in range(300))
    rows = [(5, a), (9, a + " "), (5, b), (3, b + " "), (None, c), (None, c + " "), (None, c), (7, "x y"), (7, "x  y"), (7, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.text.split()[0]) for r in drop_near_copies(docs).collect()), key=str)
    assert got == sorted([(5, "alpha0"), (3, "beta0"), (None, "gamma0"), (7, "x")], key=str)


def test_a_row_without_an_id_goes_before_one_with_an_id(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (8, "a b c d")], "doc_id long, text string")
    assert [r.doc_id for r in drop_near_copies(docs).collect()] == [8]
