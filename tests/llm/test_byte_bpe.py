import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import AWKWARD, SF_DIR, awkward, empty
from tickloom.llm.byte_bpe import ByteBpe, digests, encode_decode

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def small():
    """Leaves so small that every text has many joins."""
    return ByteBpe(PATH, PATTERN, text_leaf=5, match_leaf=3, ids_leaf=4)


pieces = st.sampled_from(
    ["a", "b", "the", " ", "  ", "\n", "'", "'re", "'s", "é", "ß", "1", "23", "!", "...", "\t", "　", "漢", "😀", "tion", "aaaa"]
)


@settings(max_examples=600, deadline=None)
@given(st.lists(pieces, max_size=40).map("".join) | st.text(max_size=40))
def test_joined_halves_are_the_whole(reference, small, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = np.frombuffer(small.encode(text), "<u4").tolist()
    assert ids == reference.encode_ordinary(text)
    assert small.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, " " * 999 + "x", "ab" * 2000, "thetion" * 500, "'re" * 700, "\n \n" * 500])
def test_long_runs(reference, small, text):
    want = reference.encode_ordinary(text)
    for bpe in (small, ByteBpe(PATH, PATTERN, match_leaf=16)):
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == want


def test_both_ways_of_merging_agree(small):
    for data in (b"", b"a", b"hello there", b"abcabcabc" * 40, "straße漢字".encode() * 20):
        assert small.merged(data) == small.merged_long(data)


def test_awkward_rows(spark, reference):
    rows = digests(encode_decode(awkward(spark), PATH, PATTERN)).collect()
    want = []
    for id_, text, *_ in AWKWARD:
        ids = np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()
        digest = [hashlib.sha256(x).hexdigest() for x in (ids, (text or "").encode())]
        want.append((id_, len(ids) // 4, *digest))
    assert sorted((tuple(r) for r in rows), key=str) == sorted(want, key=str)
    assert encode_decode(empty(spark), PATH, PATTERN).count() == 0


def test_all_documents_of_the_table(spark, reference):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in digests(encode_decode(docs, PATH, PATTERN)).collect()}
    for row in docs.select("doc_id", "text").collect():
        ids = np.array(reference.encode_ordinary(row.text or ""), "<u4").tobytes()
        assert got[row.doc_id] == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
