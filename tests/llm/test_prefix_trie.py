import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import words
from tickloom.llm import prefix_trie as module
from tickloom.llm.prefix_trie import prefix_trie, settle

SCHEMA = "conv_id long, turn long, role string, text string, owner string, Depth string"


def sha(role, text):
    return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()


def brute(rows, every=20, heads=4):
    """Every node by following every conversation turn by turn."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, sha(role or "", text or ""), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        rebuilt[c] = turns.get(base, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, way in rebuilt.items():
        for d in range(len(way) + 1):
            members[tuple(way[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    out = {}
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own_words = len(words(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * own_words + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        last = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        out[min(members[node]), len(node)] = (
            min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]),
            leaves[node], saved[node], hashlib.sha256(last.encode()).hexdigest(),
        )
    return out


def got(df):
    rows = df.collect()
    out = {
        (r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in rows
    }
    assert len(out) == len(rows)
    return out


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)


def random_rows(seed, convs=90, most=9):
    pick = random.Random(seed)
    texts = [None, "", "one", "one two", "ß three  four\n", "x" * 3000]
    rows = []
    for c in pick.sample(range(-40, 200), convs):
        for turn in range(pick.randint(1, most)):
            rows.append((c, pick.choice([turn, turn, None, 1]), pick.choice(["user", "bot", None]), pick.choice(texts)))
    rows += rows[:5] + [(None, 1, "user", "lost"), (None, None, None, None)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, small, block, ids", [(1, 20_000, 1 << 16, 1 << 12), (2, 3, 2, 3), (3, 1, 3, 50)])
def test_equals_the_plain_trie(spark, monkeypatch, seed, small, block, ids):
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "IDS", ids)
    rows = random_rows(seed, convs=90 if small > 3 else 40, most=9 if small > 3 else 5)
    assert got(prefix_trie(table(spark, rows), small=small)) == brute(rows)


def test_a_deep_conversation_and_a_crowd_of_copies(spark):
    deep = [(5, t, "user", f"turn {t}") for t in range(700)]
    copies = [(100 + c, t, "bot", f"same {t}") for c in range(300) for t in range(3)]
    rows = deep + copies
    assert got(prefix_trie(table(spark, rows), small=100)) == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "hi") for c in range(41, 60)]
    out = got(prefix_trie(table(spark, rows)))
    assert out == brute(rows) and out[41, 0][1] == 19


def test_no_conversations(spark):
    assert prefix_trie(table(spark, [])).count() == 0
    assert prefix_trie(table(spark, [(None, 1, "a", "b")])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 5), st.integers(0, 9)), min_size=1, max_size=60))
def test_centroids_give_the_totals_of_any_tree(drawn):
    """Nodes are drawn with a parent among those before them, their own weight, and a value."""
    parents = [-1] + [p % i for i, (p, _, _) in enumerate(drawn) if i]
    weights, plain = [w for _, w, _ in drawn], [v for _, _, v in drawn]
    leaves = [int(i not in parents) for i in range(len(parents))]
    totals, counts = list(plain), list(leaves)
    for i in range(len(parents) - 1, 0, -1):
        weights[parents[i]] += weights[i]
        totals[parents[i]] += totals[i]
        counts[parents[i]] += counts[i]
    assert settle(parents, weights, leaves, plain) == (counts, totals)


def test_components_go_on_in_the_next_batch():
    import pandas as pd

    rows = pd.DataFrame({
        "conv_id": [1, 1, 1, 2, 2, 3], "depth": [1, 2, 3, 1, 2, 1], "parent": [0.0, 1, 1, 0, 2, None],
        "n_convs": 1, "n_children": [1, 1, 0, 1, 0, 0], "weight": [3, 2, 1, 2, 1, 1], "leaves": [0, 0, 1, 0, 1, 1],
        "saved": [1, 2, 4, 8, 16, 32], "all_leaves": 0, "all_saved": 0, "top": [1, 1, 1, 2, 2, 3],
        "top_depth": 1,
    })
    want = {(1, 1): 7, (1, 2): 6, (1, 3): 4, (2, 1): 24, (2, 2): 16, (3, 1): 32}
    for step in range(1, 7):
        batches = [rows[i : i + step].reset_index(drop=True) for i in range(0, 6, step)]
        out = pd.concat(module._settle_rows(iter(batches)))
        assert dict(zip(zip(out["conv_id"], out["depth"]), out["all_saved"])) == want
    assert Counter(out["all_leaves"]) == {1: 6}
