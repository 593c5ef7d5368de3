"""Token-id files: patched frame-of-reference blocks, indexed by block starts.

Layout of a file, little-endian:

    "PFR1"  u32 block length  u64 values  u64 documents  u64 blocks
    i64 id and u8 "has an id" of each document, u64 length of each document
    u64 start of each block in the payload, and the payload's length
    payload

A block holds u32 minimum, u8 width, u16 exceptions, the low `width` bits of every value less the
minimum, then u16 positions and u32 upper parts of the exceptions. The width is what a percentile
of the block's values needs, the one of `PERCENTILES` that makes the block smallest; values above
it are the exceptions, patched in after unpacking. A block shorter than the block length is filled
up with its first value. One block, or the blocks of one document, can be read by their starts.

Documents are encoded by a tokenizer of the tokenizers library, the end id is appended, and each
range of ids becomes files in ascending order of id. A task renames a file when it is complete and
always gives it the same name and content, so a task that runs twice, or is lost, does no harm.

Defined cases: a null or empty text is the end id alone; the string of a special token in a text is that
token's id, as the library gives it; a null id comes first; rows that share an id, or have none, follow each
other by the first `START` characters of their text, equal ones as they are read; no documents give no files and an empty result. Other columns are
not read. A task holds one file's ids, `FILE_VALUES` and one document at most.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.hadoop import qualified
from tickloom.llm.common import text_or_empty, written
from tickloom.scratch import fresh_path

MAGIC = b"PFR1"
HEADER = struct.Struct("<4sIQQQ")
BLOCK = 128
#: Blocks that are packed or unpacked together; their bits are spread out meanwhile.
BLOCKS_AT_ONCE = 2048
#: Candidates for the width of a block: what these percentiles of its values need.
PERCENTILES = (75, 90, 97, 100)
FILE_VALUES = 8_000_000
END_ID = 2
#: Words whose ids an encoder remembers; beyond that it forgets all and starts again.
WORDS_KEPT = 1_000_000
#: Plain letters lie before this sign: Latin, Greek and Cyrillic.
LAST_PLAIN = "\u0530"
TEXTS_AT_ONCE = 500
#: Characters by which rows of one id are put in order.
START = 64

_BITS = np.array([int(x).bit_length() for x in range(256)], dtype=np.uint8)


def _bit_length(x: np.ndarray) -> np.ndarray:
    """Of unsigned 32-bit integers."""
    parts = x.astype("<u4").reshape(-1, 1).view(np.uint8)
    high = np.where(parts != 0, _BITS[parts] + np.arange(4, dtype=np.uint8) * 8, 0)
    return high.max(axis=1).reshape(x.shape)


def _widths(rows: np.ndarray, percentiles: tuple[float, ...]) -> np.ndarray:
    """Of each block, the width of the percentile that needs the fewest bits."""
    block = rows.shape[1]
    in_order = np.sort(rows, axis=1)
    best = bits = None
    for p in sorted(percentiles):
        width = _bit_length(in_order[:, min(block - 1, int(block * p / 100))]).astype(np.int64)
        top = ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
        needed = block * width + 48 * (in_order > top[:, None]).sum(axis=1)
        if best is None:
            best, bits = width, needed
        else:
            best, bits = np.where(needed < bits, width, best), np.minimum(needed, bits)
    return best


def pack_blocks(
    values: np.ndarray, block: int = BLOCK, percentiles: tuple[float, ...] = PERCENTILES
) -> tuple[np.ndarray, bytes]:
    """The starts of the blocks, with the payload's length at the end, and the payload."""
    starts, parts, size = [np.zeros(1, np.uint64)], [], 0
    for at in range(0, len(values), block * BLOCKS_AT_ONCE):
        some, payload = _pack(values[at : at + block * BLOCKS_AT_ONCE], block, percentiles)
        starts.append(some[1:] + np.uint64(size))
        parts.append(payload)
        size += len(payload)
    return np.concatenate(starts), b"".join(parts)


def _pack(values: np.ndarray, block: int, percentiles: tuple[float, ...]) -> tuple[np.ndarray, bytes]:
    values = np.ascontiguousarray(values, dtype=np.uint32)
    n = -(-len(values) // block)
    rows = np.empty((n, block), np.uint32)
    rows.reshape(-1)[: len(values)] = values
    rows.reshape(-1)[len(values) :] = rows[-1, 0]
    least = rows.min(axis=1)
    rows -= least[:, None]
    width = _widths(rows, percentiles)
    over = rows.astype(np.uint64) >> width[:, None].astype(np.uint64)
    found, place = np.nonzero(over)
    count = np.bincount(found, minlength=n)
    packed = -(-block * width // 8)
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(7 + packed + 6 * count, out=starts[1:])
    out = np.zeros(starts[-1], np.uint8)

    def put(at: np.ndarray, what: np.ndarray) -> None:
        out[at[:, None] + np.arange(what.shape[1])] = what

    put(starts[:-1], least.astype("<u4").reshape(-1, 1).view(np.uint8))
    out[starts[:-1] + 4] = width
    put(starts[:-1] + 5, count.astype("<u2").reshape(-1, 1).view(np.uint8))
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        bits = np.unpackbits(rows[at].astype(">u4").view(np.uint8).reshape(len(at), block, 4), axis=2)
        put(starts[at] + 7, np.packbits(bits[:, :, 32 - w :].reshape(len(at), -1), axis=1))
    if len(found):
        nth = np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count)
        first = (starts[:-1] + 7 + packed)[found]
        put(first + 2 * nth, place.astype("<u2").reshape(-1, 1).view(np.uint8))
        put(first + 2 * count[found] + 4 * nth, over[found, place].astype("<u4").reshape(-1, 1).view(np.uint8))
    return starts.astype(np.uint64), out.tobytes()


def unpack_blocks(starts: np.ndarray, payload: bytes, values: int, block: int = BLOCK) -> np.ndarray:
    """The first `values` values of the blocks that begin at `starts`."""
    data, begin = np.frombuffer(payload, np.uint8), starts[:-1].astype(np.int64)
    parts = [_unpack(begin[at : at + BLOCKS_AT_ONCE], data, block) for at in range(0, len(begin), BLOCKS_AT_ONCE)]
    return np.concatenate([np.zeros(0, np.uint32), *parts])[:values]


def _unpack(begin: np.ndarray, data: np.ndarray, block: int) -> np.ndarray:
    n = len(begin)

    def get(at: np.ndarray, length: int, kind: str) -> np.ndarray:
        return np.ascontiguousarray(data[at[:, None] + np.arange(length)]).view(kind)

    least = get(begin, 4, "<u4").reshape(-1)
    width = data[begin + 4].astype(np.int64)
    count = get(begin + 5, 2, "<u2").reshape(-1).astype(np.int64)
    packed = -(-block * width // 8)
    rows = np.zeros((n, block), np.uint32)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        bits = np.unpackbits(get(begin[at] + 7, int(-(-block * w // 8)), "u1"), axis=1)[:, : block * w]
        wide = np.zeros((len(at), block, 32), np.uint8)
        wide[:, :, 32 - w :] = bits.reshape(len(at), block, w)
        rows[at] = np.packbits(wide, axis=2).view(">u4").reshape(len(at), block)
    found = np.repeat(np.arange(n), count)
    if len(found):
        nth = np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count)
        first = (begin + 7 + packed)[found]
        place = get(first + 2 * nth, 2, "<u2").reshape(-1)
        upper = get(first + 2 * count[found] + 4 * nth, 4, "<u4").reshape(-1).astype(np.uint64)
        rows[found, place] |= (upper << width[found].astype(np.uint64)).astype(np.uint32)
    rows += least[:, None]
    return rows.reshape(-1)


def file_bytes(ids: list[int | None], lengths: list[int], values: np.ndarray, block: int = BLOCK) -> bytes:
    starts, payload = pack_blocks(values, block)
    return b"".join((
        HEADER.pack(MAGIC, block, len(values), len(ids), len(starts) - 1),
        np.array([0 if x is None else x for x in ids], "<i8").tobytes(),
        np.array([x is not None for x in ids], "u1").tobytes(),
        np.array(lengths, "<u8").tobytes(),
        starts.astype("<u8").tobytes(),
        payload,
    ))


def parse_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """The document ids, their lengths, and all values of a file."""
    magic, block, values, docs, blocks = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token-id file")
    at = HEADER.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    ids, has, lengths, starts = take("<i8", docs), take("u1", docs), take("<u8", docs), take("<u8", blocks + 1)
    named = [int(x) if y else None for x, y in zip(ids, has)]
    return named, lengths.astype(np.int64), unpack_blocks(starts, data[at:], values, block)


class WordEncoder:
    """The ids, as little-endian 32-bit integers, of texts, by way of their words.

    The tokenizer lower-cases, splits at white space and between letters and other signs, and drops
    the white space, all before it merges anything. So the ids of a text are those of its words one
    after the other, those of a word are those of its stem and of the signs after it, and each part
    needs to be encoded only once. New parts are encoded many at a time, with a sign between them
    that none of them holds. Plain ones, lower-case letters of Europe's alphabets, need no more than
    the merges: the tokenizer's own preparation of the text would leave them as they are. When
    `WORDS_KEPT` are known, new ones are forgotten at once, unless they are so many that the known
    ones must be of another kind of text.
    """

    MARK = "#"
    #: All ASCII signs but the apostrophe, which may belong to the letters after it.
    SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        #: As the library encodes a whole text: a special token's own string is its id.
        self.whole = Tokenizer.from_file(path)
        added = self.whole.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        self.special_lower = [t.content.lower() for t in added if t.normalized]
        #: For words of texts without such strings, which a word may spell once its capitals are small.
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # The signs by which the vocabulary writes the bytes 0 to 255.
        byte_signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {b: byte_signs.pre_tokenize_str(chr(b))[0][0][-1] for b in range(128)}
        self.signs |= {b: byte_signs.pre_tokenize_str(chr(b))[0][0][-1] for b in range(128, 192)}
        self.signs |= {b: byte_signs.pre_tokenize_str(bytes([b, 128]).decode())[0][0][0] for b in range(194, 224)}
        self.mark = self._ids([self.MARK])[0]
        self.known: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, part: bytes) -> str | None:
        """A part by its bytes' signs, if it is plain."""
        if part.isalpha():
            return part.lower().decode("ascii")
        word = part.decode("utf-8")
        if word.isalpha() and max(word) < LAST_PLAIN and word.lower() == word and is_normalized("NFC", word):
            return part.decode("latin-1").translate(self.signs)
        return None

    def _merged(self, plain: dict[bytes, str]) -> dict[bytes, bytes]:
        parts, out = list(plain), {}
        groups = [parts[i : i + 256] for i in range(0, len(parts), 256)]
        joined = [" ".join(plain[p] for p in group) for group in groups]
        for group, found in zip(groups, self.merges.encode_batch(joined, add_special_tokens=False)):
            raw, word = np.array(found.ids, "<u4").tobytes(), np.array(found.word_ids)
            ends = [*(4 * np.flatnonzero(word[1:] != word[:-1]) + 4).tolist(), len(raw)]
            out |= {p: raw[a:b] for p, a, b in zip(group, [0, *ends], ends, strict=False)}
        return out

    def _encoded(self, parts: list[bytes]) -> dict[bytes, bytes]:
        plain = {p: x for p in parts if (x := self._plain(p))}
        return self._merged(plain) | self._others([p for p in parts if p not in plain])

    def _others(self, parts: list[bytes]) -> dict[bytes, bytes]:
        mark = self.MARK.encode()
        single = [p for p in parts if mark in p or len(self.mark) != 1]
        out = {p: np.array(x, "<u4").tobytes() for p, x in zip(single, self._ids([p.decode() for p in single]))}
        several = [p for p in parts if p not in out]
        groups = [several[i : i + 256] for i in range(0, len(several), 256)]
        joined = self._ids([f" {self.MARK} ".join(p.decode() for p in group) for group in groups])
        for group, ids in zip(groups, joined):
            values = np.array(ids, "<u4")
            raw, ends = values.tobytes(), (4 * np.flatnonzero(values == self.mark[0])).tolist()
            out |= {
                p: raw[start:end]
                for p, start, end in zip(group, [0, *(e + 4 for e in ends)], [*ends, len(raw)], strict=True)
            }
        return out

    def _new(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of words that are not known, and of their stems and signs."""
        known, parts, pairs = self.known, set(), []
        for word in words:
            stem = word.rstrip(self.SIGNS)
            if len(stem) == len(word) or not stem or not stem.decode()[-1].lower()[-1].isalnum():
                parts.add(word)
                continue
            signs = word[len(stem) :]
            pairs.append((word, stem, signs))
            if stem not in known:
                parts.add(stem)
            if signs not in known:
                parts.add(signs)
        found = self._encoded(list(parts))
        for word, stem, signs in pairs:
            first, last = found.get(stem), found.get(signs)
            found[word] = (known[stem] if first is None else first) + (known[signs] if last is None else last)
        return found

    def _is_special(self, text: str) -> bool:
        return any(x in text for x in self.special) or any(x in text.lower() for x in self.special_lower)

    @staticmethod
    def _words(text: str) -> list[bytes]:
        """The words, A-Z in lower case where that changes nothing.

        The tokenizer composes characters before it makes them small. Some capitals have no composed form
        where their small letters have one, so they stay capitals unless the text is composed either way.
        """
        # bytes.lower() and bytes.split() know ASCII letters and white space only.
        raw = text.encode("utf-8")
        low = raw.lower()
        if text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", low.decode("utf-8")):
            return low.split()
        return raw.split()

    def ids(self, texts: list[str]) -> list[bytes]:
        special = [i for i, text in enumerate(texts) if self._is_special(text)]
        if not special:
            return self._ids_of_words(texts)
        out = self._ids_of_words(["" if i in special else text for i, text in enumerate(texts)])
        for i in special:
            out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes()
        return out

    def _ids_of_words(self, texts: list[str]) -> list[bytes]:
        rows, new, count = [], set(), 0
        for text in texts:
            words = self._words(text)
            parts, gaps, at = list(map(self.known.get, words)), [], -1
            for _ in range(parts.count(None)):
                at = parts.index(None, at + 1)
                gaps.append(at)
                new.add(words[at])
            rows.append((words, parts, gaps))
            count += len(words)
        found = self._new(new) if new else {}
        out, missed = [], 0
        for words, parts, gaps in rows:
            for at in gaps:
                parts[at] = found[words[at]]
            out.append(b"".join(parts))
            missed += len(gaps)
        if len(self.known) + len(found) <= WORDS_KEPT:
            self.known |= found
        elif 2 * missed > count:
            self.known = {}
        return out


@lru_cache(1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _store(folder: str, name: str, data: bytes) -> None:
    """Writes a file under a hidden name, which Spark's readers pass over, and renames it."""
    from pyarrow import fs

    if folder.startswith("file:"):
        system, root = fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    else:
        system, root = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    system.create_dir(root)
    hidden = f"{root}/_{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as out:
        out.write(data)
    system.move(hidden, f"{root}/{name}")


def _writer(folder: str, tokenizer: str, end_id: int, block: int, file_values: int) -> Callable:
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = word_encoder(tokenizer).ids
        part, number = TaskContext.get().partitionId(), 0
        ids, lengths, parts, held = [], [], [], 0

        def stored() -> pd.DataFrame:
            nonlocal ids, lengths, parts, held, number
            data = file_bytes(ids, lengths, np.frombuffer(b"".join(parts), "<u4"), block)
            _store(folder, f"part-{part:06d}-{number:06d}.pfr", data)
            row = pd.DataFrame({"part": [part], "number": [number], "docs": [len(ids)], "tokens": [held]})
            ids, lengths, parts, held, number = [], [], [], 0, number + 1
            return row

        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                some = batch.iloc[at : at + TEXTS_AT_ONCE]
                for doc, missing, coded in zip(some["doc_id"], some["no_id"], encode(list(some["content"]))):
                    ids.append(None if missing else int(doc))
                    lengths.append(len(coded) // 4 + 1)
                    parts += (coded, end)
                    held += lengths[-1]
                    if held >= file_values:
                        yield stored()
        if ids:
            yield stored()

    return write


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block: int = BLOCK,
    file_values: int = FILE_VALUES,
) -> DataFrame:
    """Writes the files below `folder`; gives part, number, docs, tokens of each."""
    # Tasks write where Spark will read: a path without a scheme means the default file system.
    folder = qualified(docs.sparkSession, folder)
    rows = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(0)).alias("doc_id"),
        F.col(id).isNull().alias("no_id"),
        text_or_empty(text).alias("content"),
    )
    # Rows of one id, or of none, stand by their text, and equal ones by where they come from, so that they part.
    rows = rows.select("*", F.substring("content", 1, START).alias("start"), F.monotonically_increasing_id().alias("from"))
    in_order = [F.col("no_id").desc(), F.col("doc_id"), F.col("start"), F.col("from")]
    spread = rows.repartitionByRange(*in_order).sortWithinPartitions(*in_order).drop("start", "from")
    write = _writer(folder, tokenizer, end_id, block, file_values)
    return written(spread.mapInPandas(write, "part int, number int, docs long, tokens long"), "token-files")


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files' bytes."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                ids, lengths, values = parse_file(content)
                part, number = map(int, path.rpartition("/")[2].removesuffix(".pfr").split("-")[1:])
                raw = memoryview(values.astype("<u4").tobytes())
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends, lengths)]
                yield pd.DataFrame({
                    "part": np.int32(part), "number": np.int32(number), "doc_id": pd.array(ids, "Int64"),
                    "skipped": ends - lengths, "n_tokens": lengths, "ids_crc32": np.array(crcs, np.int64),
                })

    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfr").load(folder)
    rows = content.select("path", "content").mapInPandas(
        decode, "part int, number int, doc_id long, skipped long, n_tokens long, ids_crc32 long"
    )
    # One row per file.
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("part", "number", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    return rows.join(before, ["part", "number"]).select(
        "doc_id", (F.col("before") + F.col("skipped")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_file_round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """The documents' tokens, written to files in the scratch folder and read back from them."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "llm-token-ids")
    return read_token_files(spark, folder, write_token_files(docs, folder, tokenizer, **options))
