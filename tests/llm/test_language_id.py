import zlib

import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, SF_DIR, awkward, empty
from tickloom.llm import language_id
from tickloom.llm.language_id import Network, fit, identify, keep_identified, text_probabilities, train


def test_gradients_match_differences():
    random = np.random.default_rng(0)
    units = language_id.UNITS
    shapes = ((256, 3 * units), (units, 3 * units), (256, 3 * units), (units, 3 * units), (2 * units, 3), (3,))
    weights = [random.standard_normal(s) * 0.4 for s in shapes]
    windows, wanted = random.integers(0, 5, (9, 6)).astype(np.uint8), random.integers(0, 3, 6)

    def network():
        return Network(["a", "b", "c"], weights[0:4:2], weights[1:4:2], weights[4], weights[5])

    def loss():
        p = language_id._position_probabilities(windows, network())
        return -np.log(p[:, np.arange(6), wanted]).mean()

    for k, gradient in enumerate(language_id._gradients(windows, wanted, network())):
        for _ in range(5):
            at = tuple(random.integers(0, d if d != 256 else 5) for d in shapes[k])
            kept, step = weights[k][at], 1e-2
            weights[k][at] = kept + step
            above = loss()
            weights[k][at] = kept - step
            below = loss()
            weights[k][at] = kept
            assert gradient[at] == pytest.approx((above - below) / (2 * step), abs=2e-4)


def test_windows_are_pooled_over_all_positions(monkeypatch):
    random = np.random.default_rng(1)
    windows = random.integers(97, 123, (40, language_id.WINDOW)).astype(np.uint8)
    net = train(windows, np.arange(40) % 2, ["x", "y"], steps=3)
    texts = [b"", b"abc", b"q" * language_id.WINDOW, b"some longer text " * 30]
    whole = text_probabilities(texts, net)
    monkeypatch.setattr(language_id, "AT_ONCE", 2)
    assert np.allclose(whole, text_probabilities(texts, net), atol=1e-6)
    assert np.allclose(whole.sum(axis=1), [0, 1, 1, 1], atol=1e-5)
    # A text of one window: the mean of its positions.
    one = language_id._position_probabilities(np.frombuffer(texts[2], np.uint8).reshape(-1, 1).copy(), net)
    assert np.allclose(whole[2], one[:, 0].mean(axis=0), atol=1e-5)


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet")
    named, lang_pred, score = identify(docs, fit(docs))
    rows = named.select("doc_id", "lang", lang_pred, score).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(rows) == docs.count() and len(held) > 200
    assert sum(r.lang == r[lang_pred] for r in held) / len(held) > 0.97
    assert all(0 <= r[score] <= 1 for r in rows)


@pytest.mark.parametrize("id_", ["cast(null as long)", "1L"])
def test_every_language_is_learned_without_ids(spark, id_):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").selectExpr(
        f"{id_} as doc_id", "text", "lang"
    )
    # A third of all rows are copies of one text in a language of its own.
    copies = spark.range(500).selectExpr(f"{id_} as doc_id", "'always the same few words' as text", "'zz' as lang")
    sample = language_id.sample_windows(docs.unionByName(copies), "doc_id", "text", "lang")
    found = sample.groupby("lang").size()
    assert set(found.index) == {r.lang for r in docs.select("lang").distinct().collect() if r.lang} | {"zz"}
    assert found["zz"] == language_id.WINDOWS_PER_TEXT
    assert found.max() < 1.5 * language_id.PER_LANGUAGE * language_id.WINDOWS_PER_TEXT


def test_texts_are_grouped_by_number_and_bytes(monkeypatch):
    monkeypatch.setattr(language_id, "TEXTS_AT_ONCE", 3)
    monkeypatch.setattr(language_id, "BYTES_AT_ONCE", 10)
    texts = [b"", b"a", b"b", b"c" * 30, b"d" * 6, b"e" * 6, b"f"]
    groups = list(language_id._together(iter(texts)))
    assert groups == [[b"", b"a", b"b"], [b"c" * 30], [b"d" * 6, b"e" * 6], [b"f"]]


def test_labels_of_held_out_documents_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    other = docs.withColumn("held", language_id.held_out()).selectExpr(
        "doc_id", "text", "if(held, 'wrong', lang) as lang", "source"
    )
    one, two = fit(docs), fit(other)
    assert one.languages == two.languages
    assert all((a == b).all() for a, b in zip(one.inputs, two.inputs))


def test_awkward_rows(spark):
    docs = awkward(spark)
    named, lang_pred, score = identify(docs, fit(docs))
    assert (lang_pred, score) == ("lang_pred", "score_")
    rows = named.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r[lang_pred], r[score]) == ("und", 0.0)
        else:
            assert r[lang_pred] != "und" and 0 < r[score] <= 1
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (2, 3, 4, 9)").count() == 0


def test_nothing_to_learn_from(spark):
    docs = awkward(spark)
    assert fit(empty(spark)) is None and identify(empty(spark), None)[0].count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    named, lang_pred, score = identify(unlabelled, fit(unlabelled))
    assert {(r[lang_pred], r[score]) for r in named.collect()} == {("und", 0.0)}


def test_a_single_language(spark):
    docs = awkward(spark).selectExpr("doc_id", "text", "'xx' as lang")
    named, lang_pred, _ = identify(docs, fit(docs))
    assert {r[lang_pred] for r in named.collect()} == {"xx", "und"}


def test_a_low_score_drops_no_document(spark, monkeypatch):
    def unsure(docs, net, text="text"):
        return docs.selectExpr("*", "if(doc_id = 3, 'und', 'en') as guess", "0.3d as sure"), "guess", "sure"

    monkeypatch.setattr(language_id, "fit", lambda *args: None)
    monkeypatch.setattr(language_id, "identify", unsure)
    docs = spark.createDataFrame([(1, "a"), (2, "de la und"), (3, "12")], "doc_id long, text string")
    assert sorted(r.doc_id for r in keep_identified(docs).collect()) == [1, 2]
