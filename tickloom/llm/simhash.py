"""SimHash near-dedup by deletion variants of fingerprint segments.

A fingerprint has a bit set if more than half of the hashes of the text's shingles have. Two
fingerprints are linked if they differ in `max_bits` bits or fewer. Cut into half as many segments
as `max_bits` + 1, rounded up, such a pair has a segment that differs in one bit at most: with
that bit, or any bit if there is none, left out, both segments are equal. So every fingerprint is
indexed by its segments with each bit left out once, equal keys are joined, and the whole
fingerprints are compared. No link is lost, whatever the texts are.

Documents with the same fingerprint are one node, so copies cost nothing. Keys that only one
fingerprint has are dropped. Under the others no pairs are made: each task compares the
fingerprints of a key with numpy and gives the links of a spanning forest, fewer than there are
fingerprints. A key with more than `block` of them is split: they fall into blocks by hash, and
each pair of blocks is a cell of its own, which any task can take.

Defined cases: a null text is the empty text; a text without words has fingerprint zero and is
linked like any other; a text with fewer words than a shingle is one shingle; every repeated row
gives a row; a null id is never the smallest of its component unless there is no other, and then
the component is null; no rows give none. Other columns are kept by `drop_near_copies`, which leaves
one row of each component, otherwise not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_names, text_or_empty, written
from tickloom.llm.graph import components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: Fingerprints that one task compares with each other, at most twice as many.
BLOCK = 2048
#: Hashes whose bits are summed at a time.
_HASHES = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text as a signed 64-bit integer."""
    # bytes.lower() and bytes.split() know ASCII letters and white space only.
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends)]
    last = ends[shingle - 1 :] or ends[-1:]
    digest = xxhash.xxh64_digest
    counts, n = np.zeros(64, np.int64), len(last)
    for at in range(0, n, _HASHES):
        some = zip(starts[at : at + _HASHES], last[at : at + _HASHES])
        hashes = b"".join([digest(joined[a:b], seed) for a, b in some])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """doc_id, fp of every row."""
    return docs.select(F.col(id).alias("doc_id"), _simhash(shingle, seed)(text_or_empty(text)).alias("fp"))


def _simhash(shingle: int, seed: int):
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle, seed) for x in texts], dtype="int64")

    return simhash


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def deletion_keys(fp: Column, max_bits: int) -> Column:
    """An array of a 64-bit fingerprint's segments with one bit left out each: 64 keys."""
    segments = -(-(max_bits + 1) // 2)
    edges = [64 * i // segments for i in range(segments + 1)]
    keys = []
    for low, high in zip(edges, edges[1:]):
        for bit in range(low, high):
            left = fp.bitwiseAND(F.lit(_signed((1 << high) - (1 << low) - (1 << bit))))
            # The bit left out tells the segment too, and takes six bits beside a short one.
            if high - low <= 58:
                keys.append(F.shiftleft(F.shiftrightunsigned(left, low), 6).bitwiseOR(F.lit(bit)))
            else:
                keys.append(F.xxhash64(left, F.lit(bit)))
    return F.array(*keys)


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links between fingerprints that tie together all that are linked, directly or by others."""
    left, links = np.arange(len(fps)), []
    while len(left):
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            at = waiting.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= max_bits
            if near.any():
                found = left[near]
                links += [(fps[at], fps[y]) for y in found]
                waiting.extend(found)
                left = left[~near]
    return links


def _cell_links(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(cell: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
            first = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(axis=1)])
            size = np.diff(np.r_[first, len(cell)])
            pairs = first[size == 2]
            near = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= max_bits]
            found = [np.stack([fp[near], fp[near + 1]], axis=1)]
            for at, n in zip(first[size > 2], size[size > 2]):
                if some := _forest(fp[at : at + n], max_bits):
                    found.append(np.array(some, np.uint64))
            both = np.unique(np.concatenate(found), axis=0).view(np.int64)
            return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

        cell, fp = np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            cell = np.concatenate([cell, batch[["key", "i", "j"]].to_numpy(np.int64)])
            fp = np.concatenate([fp, batch["fp"].to_numpy(np.int64).view(np.uint64)])
            if not len(cell):
                continue
            # The last cell may go on in the next batch.
            end = int(np.argmax((cell == cell[-1]).all(axis=1)))
            if end:
                yield links(cell[:end], fp[:end])
                cell, fp = cell[end:], fp[end:]
        if len(cell):
            yield links(cell, fp)

    return run


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """a, b: links that tie together all distinct fingerprints (fp) within `max_bits` of each other."""
    index = nodes.select(F.explode(deletion_keys(F.col("fp"), max_bits)).alias("key"), "fp")
    crowded = written(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "keys")
    parts = F.ceil(F.col("n") / block).cast("int")
    # Both sides shuffled at any size, so that the rows of a crowded key can be split.
    shared = index.join(crowded.hint("merge"), "key").select(
        "key", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts.cast("long")).cast("int").alias("own")
    )
    cells = shared.select(
        "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    ).select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    in_order = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
    return in_order.mapInPandas(_cell_links(max_bits), "a long, b long")


def _tied(nodes: DataFrame, max_bits: int, block: int) -> DataFrame:
    """fp, least of every node and the root of its component."""
    roots = components(near_links(nodes, max_bits, block))
    tied = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return written(tied.select("fp", "least", F.coalesce("root", "fp").alias("root")), "tied")


def near_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id of all it is linked with)."""
    rows = written(fingerprints(docs, id, text, shingle, seed), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    tied = _tied(nodes, max_bits, block)
    smallest = written(tied.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    classes = written(tied.join(smallest, "root").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """One row of each component of `docs`, with all its columns.

    It is the one with the smallest id, null ids last; of rows that repeat an id, the first by
    fingerprint, hash of the text and place in the table. Only numbers of rows that go meet the texts.
    """
    fp, row = names = free_names(docs, "fp", "row")
    # Written, so that a row keeps its number.
    rows = docs.select(
        "*", _simhash(shingle, seed)(text_or_empty(text)).alias(fp), F.monotonically_increasing_id().alias(row)
    )
    rows = written(rows, "numbered")
    keys = rows.select(
        F.col(fp).alias("fp"),
        F.col(row).alias("row"),
        F.struct(
            F.col(id).isNull().alias("no_id"),
            F.col(id).alias("id"),
            F.col(fp).alias("fp"),
            F.xxhash64(text_or_empty(text)).alias("hash"),
            F.col(row).alias("row"),
        ).alias("place"),
    )
    nodes = written(keys.groupBy("fp").agg(F.min("place").alias("least")), "nodes")
    tied = _tied(nodes, max_bits, block)
    first = written(tied.groupBy("root").agg(F.min("least").alias("first")), "smallest")
    stays = written(tied.join(first, "root").select("fp", F.col("first.row").alias("stays")), "classes")
    gone = keys.select("fp", "row").join(stays, "fp").where("row <> stays")
    gone = written(gone.select(F.col("row").alias(row)), "near-copies")
    return rows.join(gone, row, "left_anti").drop(*names)
