import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import AWKWARD, SF_DIR, awkward, empty, words
from tickloom.llm import lm_score, maxent
from tickloom.llm.lm_score import score_texts

NO_WORD = "no word has a blank"


def plain(rows):
    """n_tokens, n_known, N and base score of each row."""
    tokens = [(i, words(t) + [NO_WORD]) for i, t in rows]
    counts = Counter()
    for i, some in tokens:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            counts.update(some)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, len(some), sum(counts[w] > 0 for w in some), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in some))
        for i, some in tokens
    ]


def compare(got, rows):
    key = lambda r: (str(r[0]), r[1], r[2])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(plain(rows), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert [r[4] for r in got] == pytest.approx([r[4] for r in want])


@pytest.mark.parametrize("heavy", [1, 40, 1 << 18])
def test_counts_and_base_scores_by_either_way(spark, monkeypatch, heavy):
    monkeypatch.setattr(lm_score, "HEAVY", heavy)
    monkeypatch.setattr(lm_score, "SEGMENT", 5000)
    monkeypatch.setattr(lm_score, "COUNTED_AT_ONCE", 50)
    rows = score_texts(awkward(spark)).collect()
    compare(rows, [(i, t) for i, t, *_ in AWKWARD])
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in rows)


def test_the_model_beats_the_base_on_held_out_texts(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "TRAINER_TOKENS", 30_000)
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet")
    rows = score_texts(docs).collect()
    compare(rows, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in rows if r.held_out]
    assert sum(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows) == len(rows)
    gain = (sum(r.score for r in held) - sum(r.base_score for r in held)) / sum(r.n_tokens for r in held)
    assert gain > 0.05


def test_lanes_give_the_same_mean(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(6).selectExpr("text as content", "0 as round")
    kinds = maxent.classes_of([b"the"], [b"ing"])
    sizes = np.ones(maxent.CLASSES)
    context = spark.sparkContext
    shared, start = context.broadcast(kinds), context.broadcast(maxent.no_weights(sizes))
    rows = docs.select("content")
    one = lm_score._train_round(rows, shared, start, 6)
    monkeypatch.setattr(lm_score, "LANE", 2)
    two = lm_score._train_round(rows, shared, start, 6)
    assert np.abs(one.table).max() > 0 and np.allclose(one.table, two.table, atol=1e-4)


def test_probabilities_sum_to_one():
    """Over all known words and the unknown one of each class, after any context."""
    counts = Counter({b"the": 50, b"a": 20, b"thing": 7, b"ring": 5, b"zu": 3, maxent.END: 9})
    kinds = maxent.classes_of([b"the", b"a"], [b"ing"])
    sizes = np.full(maxent.CLASSES, 0.5)
    for w, n in counts.items():
        sizes[kinds.of(w)] += n + 0.5
    weights = maxent.no_weights(sizes)
    batch = maxent.batch_of([[b"the", b"thing", b"a", b"zu", maxent.END]], kinds)
    maxent.learn(weights, batch)
    shares = maxent.shares(weights, batch.buckets)
    within = np.full(maxent.CLASSES, 0.5)  # the unknown words
    for w, n in counts.items():
        within[kinds.of(w)] += n + 0.5
    assert (shares @ (within / sizes)) == pytest.approx(np.ones(5), abs=1e-5)


def test_gradient_steps_raise_the_likelihood():
    texts = [maxent.words_of(x) for x in ["the cat sat on the mat", "der hund lag auf der matte"] * 50]
    kinds = maxent.classes_of([b"the", b"der", b"on", b"auf"], [b"cat", b"und"])
    batch = maxent.batch_of(texts, kinds)
    weights = maxent.no_weights(np.bincount(batch.classes, minlength=maxent.CLASSES) + 0.5)
    before = maxent.log10_class(weights, batch).sum()
    for _ in range(20):
        maxent.learn(weights, batch)
    assert maxent.log10_class(weights, batch).sum() > before / 2


def test_nothing_to_learn_from(spark):
    assert score_texts(empty(spark)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    docs = spark.createDataFrame([(held, "a b c")], "doc_id long, text string")
    (r,) = score_texts(docs).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 4, 0, 0, 0.0)


def test_the_third_word_before_speaks_and_classes_are_whole():
    assert maxent.CLASSES == 73 and maxent.STEP_TOKENS == 8192
    kinds = maxent.classes_of([], [])
    one = maxent.batch_of([[b"a", b"x", b"y", b"z"]], kinds)
    two = maxent.batch_of([[b"b", b"x", b"y", b"z"]], kinds)
    assert (one.buckets[:, 3] != two.buckets[:, 3]).sum() == 1


def test_buckets_grow_with_the_distinct_words():
    found = [maxent.buckets_for(n) for n in (0, 400_000, 4_000_000, 10**12)]
    assert found == [1 << 13, 1 << 14, 1 << 17, 1 << 18]
    kinds = maxent.classes_of([b"the"], [b"ing"])
    batch = maxent.batch_of([[b"%d" % i for i in range(50_000)]], kinds, 1 << 17)
    assert batch.buckets.max() >= 1 << 16 and len(np.unique(batch.buckets)) > 1 << 16
    weights = maxent.no_weights(np.ones(maxent.CLASSES), 1 << 17)
    maxent.learn(weights, batch)
    assert (np.abs(weights.table).max(axis=1) > 0).sum() > 1 << 16


def test_context_goes_on_over_the_border_of_a_segment(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(40))
    kinds = maxent.classes_of([b"w1"], [b"w4"])
    (_, groups, before), = lm_score._segments([text, "a b"])
    whole = maxent.batch_of(groups, kinds, before=before)
    monkeypatch.setattr(lm_score, "SEGMENT", 7)
    (places, groups, before), = lm_score._segments([text, "a b"])
    parts = maxent.batch_of(groups, kinds, before=before)
    assert places == [0] * 6 + [1] and parts.lengths.tolist() == [len(g) for g in groups]
    assert (parts.buckets == whole.buckets).all() and (parts.classes == whole.classes).all()
    assert [parts.words[t] for t in parts.token] == [whole.words[t] for t in whole.token]


def test_a_task_sends_one_sum_of_its_trainers(spark):
    """Two trainers in a task end with the mean that they have in tasks of their own."""
    texts = ["the old man sang to me " * 50_000, "der alte mann sang w1 w2 " * 50_000]
    docs = spark.createDataFrame([(t,) for t in texts], "content string").coalesce(1)
    kinds = maxent.classes_of([b"the", b"der"], [b"ang"])
    shared, start = (spark.sparkContext.broadcast(x) for x in (kinds, maxent.no_weights(np.ones(maxent.CLASSES))))
    groups = list(lm_score._segments(texts))
    assert [places for places, _, _ in groups] == [[0, 0], [1, 1]]
    got = lm_score._train_round(docs, shared, start, 1, 300_000)
    ends, sizes = [], []
    for _, words_, before in groups:
        own, batch = maxent.no_weights(np.ones(maxent.CLASSES)), maxent.batch_of(words_, kinds, before=before)
        maxent.learn(own, batch)
        ends.append(own)
        sizes.append(len(batch.token))
    assert np.abs(ends[0].table - ends[1].table).max() > 0.1
    for name in ("table", "seen"):
        mean = sum(n * getattr(w, name) for n, w in zip(sizes, ends)) / sum(sizes)
        assert getattr(got, name) == pytest.approx(mean, rel=1e-4, abs=1e-4)


def test_what_trainers_exchange_grows_with_their_tokens_only(spark, monkeypatch):
    """Tables of weights that are sent: one for two trainers, so fewer than trainers."""
    asked = []
    monkeypatch.setattr(lm_score, "_train_round", lambda part, kinds, start, tasks, turn=None: asked.append((tasks, turn)))
    learned = spark.createDataFrame([("a", 0)], "content string, round int")
    most = lm_score.TRAINER_TOKENS
    for trainers in (1, 2, 7, 100):
        kinds, sizes = maxent.classes_of([], []), np.ones(maxent.CLASSES)
        lm_score.train(learned, kinds, sizes, trainers * most * lm_score.ROUNDS)
    tasks, turns = zip(*asked[:: lm_score.ROUNDS])
    assert tasks == (1, 1, 3, 50)
    # No trainer reads fewer tokens than it is meant to.
    assert turns[0] == math.inf and all(t >= most for t in turns[1:])


def test_a_step_moves_buckets_by_the_plain_gradient(monkeypatch):
    monkeypatch.setattr(maxent, "OFTEN", 3)
    texts = [maxent.words_of("the cat sat on the mat and the cat ran " * k) for k in (1, 2, 9)]
    kinds = maxent.classes_of([b"the", b"cat"], [b"and"])
    batch = maxent.batch_of(texts, kinds)
    weights = maxent.no_weights(np.bincount(batch.classes, minlength=maxent.CLASSES) + 0.5)
    maxent.learn(weights, batch)
    table, seen = weights.table.copy(), weights.seen.copy()
    error = maxent.shares(weights, batch.buckets).astype(np.float64)
    error[np.arange(len(error)), batch.classes] -= 1
    gradient = np.zeros(table.shape)
    for row in batch.buckets:
        np.add.at(gradient, row, error)
    maxent.learn(weights, batch)
    seen = seen + (gradient**2).sum(axis=1)
    assert weights.seen == pytest.approx(seen, rel=1e-4, abs=1e-4)
    want = table - gradient * (maxent.RATE / np.sqrt(seen + 1))[:, None]
    assert weights.table == pytest.approx(want, rel=1e-4, abs=1e-5)


def test_factors_score_as_weights_do():
    texts = [maxent.words_of(x) for x in ["the cat sat on the mat", "der hund lag auf der matte", ""] * 20]
    kinds = maxent.classes_of([b"the", b"der"], [b"cat"])
    batch = maxent.batch_of(texts, kinds)
    weights = maxent.no_weights(np.bincount(batch.classes, minlength=maxent.CLASSES) + 0.5)
    for _ in range(20):
        maxent.learn(weights, batch)
    factors = maxent.for_scoring(weights)
    assert isinstance(factors, maxent.Factors)
    plain = maxent.log10_class(weights, batch)
    assert maxent.log10_class(factors, batch) == pytest.approx(plain, abs=1e-5)
    # Products of larger weights would leave the range of 32 bits.
    weights.table[batch.buckets[0, 0], 0] = 17
    assert maxent.for_scoring(weights) is weights


def test_classes_and_endings_of_many_words_as_of_one():
    found = [b"the", b"", b"...", b"thing!!", b"a!b", "straße".encode(), "漢字。".encode(), b"x" * 500, b"ng"]
    kinds = maxent.classes_of([b"the", b"..."], [b"ing", b"", "字".encode()])
    words_ = pa.array(found, pa.large_binary())
    assert maxent.endings_of(words_).to_pylist() == [maxent.ending_of(w) for w in found]
    assert kinds.of_all(words_).tolist() == [kinds.of(w) for w in found]


def test_words_are_counted_as_they_are_split(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "TEXTS_AT_ONCE", 3)
    monkeypatch.setattr(lm_score, "COUNTED_AT_ONCE", 40)
    texts = ["A b\x0bc\x1cd\x85e F g", "", " \t", "İx ÄB ﬁ I", "one two " * 50, "x\r\ny\x0cz\x00 q"] * 5
    docs = spark.createDataFrame([(t,) for t in texts], "content string").coalesce(1)
    want = Counter(w for t in texts for w in maxent.words_of(t))
    runs = list(lm_score._runs(pa.array(texts, pa.string())))
    assert [len(r) for r in runs] == [3] * 10
    assert Counter(w for r in runs for w in lm_score._words(r).to_pylist()) == want
    assert {bytes(r.word): r.n for r in lm_score.word_counts(docs).collect()} == want
