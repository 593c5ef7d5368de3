"""Byte-level BPE as a monoid: halves are encoded on their own and joined at their boundary.

Two joins, each from the same idea: encode a window round the boundary again, and let it grow until
what lies outside provably stays as it is.

* Pieces. The pattern's matches cover a text without gaps, and a match depends only on where it
  starts and on the text up to `AHEAD` characters past its end. So the left half's matches that end
  that far before the boundary hold; the text after them is split again until a new match starts
  where one of the right half's does. From there on the right half's matches hold.
* Tokens inside one long match. A sequence of tokens is the encoding of its bytes if every two
  neighbours are, so the window needs to grow only until both of its edges are such pairs.

Decoding joins the bytes of halves. Texts of any length are taken whole; memory stays in proportion
to the text. A null text is the empty text and has no ids; strings that look like special tokens
are ordinary text. Rows are independent, so repeated rows and ids do no harm, other columns are
kept or not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import text_or_empty

#: Characters of a leaf of the text's tree, bytes of a leaf of a match's tree, ids of a decoding leaf.
TEXT_LEAF, MATCH_LEAF, IDS_LEAF = 16_384, 64, 65_536
#: How far past its end a match may look: "'re" against "'" alone is two.
AHEAD = 3
#: Matches whose ids an encoder remembers; beyond that it forgets all and starts again.
MATCHES_KEPT = 800_000

_NONE = 1 << 62


class ByteBpe(dict):
    """Encodes and decodes by the ranks of a .tiktoken file. The mapping: a match to its ids' bytes."""

    def __init__(
        self,
        path: str,
        pattern: str,
        text_leaf: int = TEXT_LEAF,
        match_leaf: int = MATCH_LEAF,
        ids_leaf: int = IDS_LEAF,
    ):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.of_byte = [self.ranks[bytes([b])] for b in range(256)]
        self.split = regex.compile(pattern).findall
        self.text_leaf, self.match_leaf, self.ids_leaf = text_leaf, match_leaf, ids_leaf
        self.pairs: dict[tuple[int, int], int] = {}
        self.stable_pairs: dict[tuple[int, int], bool] = {}

    # Tokens of one match

    def pair(self, a: int, b: int) -> int:
        """The token that two neighbours merge into; tokens merge in the order of their numbers."""
        out = self.pairs.get((a, b))
        if out is None:
            out = self.pairs[a, b] = self.ranks.get(self.tokens[a] + self.tokens[b], _NONE)
        return out

    def merged(self, data: bytes) -> list[int]:
        """The tokens by merging the first of the lowest pairs again and again: for short data."""
        ids = [self.of_byte[b] for b in data]
        found = [self.pair(a, b) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != _NONE:
            i = found.index(best)
            ids[i : i + 2] = [best]
            del found[i]
            if i < len(found):
                found[i] = self.pair(best, ids[i + 1])
            if i:
                found[i - 1] = self.pair(ids[i - 1], best)
        return ids

    def merged_long(self, data: bytes) -> list[int]:
        """The same by a queue of pairs, for windows that had to grow far."""
        ids = [self.of_byte[b] for b in data]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = [(rank, i) for i in range(len(ids) - 1) if (rank := self.pair(ids[i], ids[i + 1])) != _NONE]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or self.pair(ids[i], ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (new := self.pair(rank, ids[after[i]])) != _NONE:
                    heappush(queue, (new, i))
            if before[i] >= 0 and (new := self.pair(ids[before[i]], rank)) != _NONE:
                heappush(queue, (new, before[i]))
        return [x for x in ids if x >= 0]

    def stable(self, a: int, b: int) -> bool:
        """Whether two tokens that stand side by side stay so."""
        out = self.stable_pairs.get((a, b))
        if out is None:
            if len(self.stable_pairs) >= MATCHES_KEPT:
                self.stable_pairs.clear()
            out = self.stable_pairs[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return out

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        reach = 1
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            data = b"".join(map(self.tokens.__getitem__, left[a:] + right[:b]))
            window = self.merged(data) if len(data) <= 8 * self.match_leaf else self.merged_long(data)
            if (not a or self.stable(left[a - 1], window[0])) and (
                b == len(right) or self.stable(window[-1], right[b])
            ):
                return left[:a] + window + right[b:]
            reach *= 2

    def match_tokens(self, data: bytes) -> list[int]:
        if len(data) <= self.match_leaf:
            return self.merged(data)
        half = len(data) // 2
        return self.join_tokens(self.match_tokens(data[:half]), self.match_tokens(data[half:]))

    def __missing__(self, match: str) -> bytes:
        if len(self) >= MATCHES_KEPT:
            self.clear()
        out = np.array(self.match_tokens(match.encode("utf-8")), "<u4").tobytes()
        if len(match) <= self.match_leaf:
            self[match] = out
        return out

    # Matches of a text

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left or right
        kept, tail = len(left), 0
        while kept and tail < AHEAD:
            kept -= 1
            tail += len(left[kept])
        text, taken, step = "".join(left[kept:]), 0, 8
        starts = {len(text): 0}
        while True:
            more = right[taken : taken + step]
            for piece in more:
                text += piece
                taken += 1
                starts[len(text)] = taken
            window, at = self.split(text), 0
            for i, piece in enumerate(window):
                # All before `at` holds, and the right half has a match that starts there.
                if at in starts and starts[at] < taken and len(text) - at >= AHEAD:
                    return left[:kept] + window[:i] + right[starts[at] :]
                at += len(piece)
            if taken == len(right):
                return left[:kept] + window
            step *= 2

    def matches(self, text: str) -> list[str]:
        if len(text) <= self.text_leaf:
            return self.split(text)
        half = len(text) // 2
        return self.join_matches(self.matches(text[:half]), self.matches(text[half:]))

    # Whole texts

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        return b"".join(map(self.__getitem__, self.matches(text)))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.ids_leaf:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(1)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_decode(
    docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, ids (little-endian 32-bit integers), n_tokens, decoded (bytes) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            ids = [bpe.encode(x) for x in batch["content"]]
            decoded = [bpe.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            counts = [len(x) // 4 for x in ids]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "ids": ids, "n_tokens": np.array(counts, np.int64), "decoded": decoded,
            })

    rows = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("content"))
    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, ids binary, n_tokens long, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
