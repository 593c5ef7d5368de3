import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import AWKWARD, SF_DIR, awkward, empty
from tickloom.llm import token_files
from tickloom.llm.token_files import (
    WordEncoder,
    file_bytes,
    pack_blocks,
    parse_file,
    read_token_files,
    token_file_round_trip,
    unpack_blocks,
    write_token_files,
)
from tickloom.scratch import fresh_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(PATH)


values = st.one_of(st.integers(0, 9), st.integers(0, 2**32 - 1), st.just(2**32 - 1), st.integers(1000, 1100))


@settings(max_examples=150, deadline=None)
@given(st.lists(values, max_size=300), st.sampled_from([1, 2, 7, 128]), st.sampled_from([(0,), (50, 100), (90,)]))
def test_blocks_round_trip(some, block, percentiles):
    array = np.array(some, np.uint32)
    starts, payload = pack_blocks(array, block, percentiles)
    assert len(starts) == -(-len(some) // block) + 1 and starts[-1] == len(payload)
    assert (unpack_blocks(starts, payload, len(some), block) == array).all()


def test_a_block_can_be_read_alone():
    array = np.arange(1000, dtype=np.uint32) ** 2
    starts, payload = pack_blocks(array, 128)
    assert (unpack_blocks(starts[3:5], payload, 128) == array[384:512]).all()


def test_outliers_cost_little():
    usual = np.tile(np.arange(16, dtype=np.uint32), 800)
    with_outliers = usual.copy()
    with_outliers[::500] = 2**31
    plain, patched = len(pack_blocks(usual)[1]), len(pack_blocks(with_outliers)[1])
    assert patched < plain * 1.1


def test_many_blocks_are_packed_in_parts(monkeypatch):
    array = np.random.default_rng(1).integers(0, 50_000, 5000).astype(np.uint32)
    whole = pack_blocks(array)
    monkeypatch.setattr(token_files, "BLOCKS_AT_ONCE", 3)
    parts = pack_blocks(array)
    assert (whole[0] == parts[0]).all() and whole[1] == parts[1]
    assert (unpack_blocks(*parts, len(array)) == array).all()


def test_file_round_trip():
    array = np.array([5, 2, 9, 9, 2], np.uint32)
    ids, lengths, back = parse_file(file_bytes([None, -3], [2, 3], array))
    assert ids == [None, -3] and lengths.tolist() == [2, 3] and (back == array).all()


parts = [*"ab.,;#'!=<1 ", "\u00e9", "\u0338", "\u0301", "\u03a3", "\u0130", "\ufb01", "\u6f22", "\t", "\n", "\x85", "\xa0", "\x1c", "\u3000"]
# Capitals without a composed form, whose small letters have one, and one the other way round.
parts += ["J\u030c", "T\u0308", "H\u0331", "W\u030a", "Y\u030a", "I\u0307", "E\u0301", "JAB", "Gr\u00d6\u00dfe"]
parts += ["the", "'re", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "<|"]
texts = st.lists(st.sampled_from(parts), max_size=30).map("".join) | st.text(max_size=30)


@settings(max_examples=400, deadline=None)
@given(texts)
def test_words_give_the_ids_of_the_text(tokenizer, encoder, text):
    text = text.encode("utf-8", "ignore").decode()
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == want


def test_words_that_were_given_away(tokenizer, encoder):
    for text in ("J\u030cab", "T\u0308x", "H\u0331", "W\u030a", "Y\u030a", "<|endoftext|> a", "x<|endoftext|>Y"):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids([text, "other"])[0], "<u4").tolist() == want


def test_all_documents_of_the_table(spark, tokenizer):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = sorted(tuple(r) for r in token_file_round_trip(docs, PATH).collect())
    assert got == plain(tokenizer, [tuple(r) for r in rows])


def test_rows_without_id_are_read_by_several_tasks(spark):
    docs = spark.range(4000).selectExpr("cast(null as long) doc_id", "if(id % 3 = 0, 'same', concat('t ', id)) text")
    folder = fresh_path(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tasks are joined otherwise
    try:
        files = write_token_files(docs, folder, PATH)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files.select("part").distinct().count() > 4 and files.agg({"docs": "sum"}).first()[0] == 4000
    rows = read_token_files(spark, folder, files).orderBy("start").collect()
    at = 0
    for r in rows:
        assert r.start == at and r.doc_id is None
        at += r.n_tokens


def test_a_full_memory_of_words_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "WORDS_KEPT", 3)
    small = WordEncoder(PATH)
    some = ["one two three.", "four five, six", "one two", "seven eight nine ten"]
    for pair in (some[:2], some[2:], some):
        want = [tokenizer.encode(x, add_special_tokens=False).ids for x in pair]
        assert [np.frombuffer(x, "<u4").tolist() for x in small.ids(pair)] == want


def plain(tokenizer, rows):
    start, out = 0, []
    for id_, text in sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        out.append((id_, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_of_awkward_rows(spark, tokenizer):
    rows = token_file_round_trip(awkward(spark), PATH, file_values=7).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(plain(tokenizer, AWKWARD), key=str)


def test_a_written_file_and_what_lies_beside_it(spark, tokenizer):
    folder = fresh_path(spark, "tokens")
    files = write_token_files(awkward(spark), folder, PATH)
    again = write_token_files(awkward(spark), folder, PATH)  # a second attempt gives the same files
    assert sorted(map(tuple, files.collect())) == sorted(map(tuple, again.collect()))
    assert read_token_files(spark, folder, files).count() == len(AWKWARD)


def test_no_documents(spark):
    assert token_file_round_trip(empty(spark), PATH).count() == 0
