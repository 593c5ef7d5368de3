"""A maximum-entropy model of word classes with hashed n-gram and skip features, in sparse numpy batches."""

from __future__ import annotations

import zlib
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The end of a text is a word without letters.
END = b""
#: The most frequent words and the most frequent endings of other words are classes of their own; all
#: that is left falls into classes by a hash of its ending.
TOP_WORDS, TOP_ENDINGS, REST = 24, 40, 8
CLASSES = 1 + TOP_WORDS + TOP_ENDINGS + REST
ENDING = 3
#: Buckets of features: a power of two, at least one for WORDS_A_BUCKET distinct words, between these
#: bounds. The upper one is what two tasks of an executor and the driver can hold.
LEAST_BUCKETS, MOST_BUCKETS, WORDS_A_BUCKET = 1 << 13, 1 << 18, 32
#: How many words before a token its features see.
REACH = 3
#: Tokens of a gradient step, and the step's size.
STEP_TOKENS, RATE = 8192, 1.0
#: Buckets that occur more often in a step are summed one by one.
OFTEN = 32
#: Sums of weights up to this have exponentials, and these inverses, that 32 bits hold.
LARGEST_SUM = 80
_BEFORE = 0x9E3779B1  # stands for words before the text
_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MIX = np.array([0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0x9E3779B1], np.uint32)
FEATURES = len(_MIX)


def words_of(text: str) -> list[bytes]:
    """The words of a text, and the end."""
    # bytes.lower() and bytes.split() know ASCII letters and white space only.
    words = text.encode("utf-8").lower().split()
    words.append(END)
    return words


def ending_of(word: bytes) -> bytes:
    return word.rstrip(_SIGNS)[-ENDING:]


def endings_of(words: pa.Array) -> pa.Array:
    """The endings of many words (`large_binary`)."""
    # Signs are ASCII and cut off as such; an ending is bytes and may begin within a character.
    bare = pc.ascii_rtrim(words.view(pa.large_string()), characters=_SIGNS.decode()).view(pa.large_binary())
    return pc.binary_slice(bare, -ENDING, None)


class Classes(NamedTuple):
    """The class of every word there may be; END is class 0."""

    words: dict[bytes, int]
    endings: dict[bytes, int]

    def of(self, word: bytes) -> int:
        found = self.words.get(word)
        if found is None:
            ending = ending_of(word)
            found = self.endings.get(ending)
            if found is None:
                found = CLASSES - REST + zlib.crc32(ending) % REST
        return found

    def of_all(self, words: pa.Array) -> np.ndarray:
        """The classes of many words (`large_binary`): each distinct ending is looked up once."""
        coded = endings_of(words).dictionary_encode()
        endings = coded.dictionary.to_pylist()
        of_ending = [self.endings.get(e, CLASSES - REST + zlib.crc32(e) % REST) for e in endings]
        out = np.array(of_ending, np.int32)[coded.indices.to_numpy()]
        own = pc.index_in(words, pa.array(list(self.words), pa.large_binary())).fill_null(-1).to_numpy()
        return np.where(own < 0, out, np.array(list(self.words.values()), np.int32)[own])


def classes_of(top_words: list[bytes], top_endings: list[bytes]) -> Classes:
    words = {w: 1 + i for i, w in enumerate(top_words[:TOP_WORDS])}
    first = 1 + TOP_WORDS
    return Classes(words | {END: 0}, {e: first + i for i, e in enumerate(top_endings[:TOP_ENDINGS])})


class Weights(NamedTuple):
    bias: np.ndarray  # (CLASSES,) natural logarithms of the classes' shares
    table: np.ndarray  # (buckets, CLASSES) weight of each class for each feature
    seen: np.ndarray  # (buckets,) squared gradients so far: features seen often move less


def buckets_for(distinct: int) -> int:
    """The buckets of a model over texts with that many distinct words."""
    buckets = LEAST_BUCKETS
    while buckets < MOST_BUCKETS and buckets * WORDS_A_BUCKET < distinct:
        buckets *= 2
    return buckets


def no_weights(sizes: np.ndarray, buckets: int = LEAST_BUCKETS) -> Weights:
    """The model before training: each class by its share, whatever stands before."""
    bias = np.log(sizes / sizes.sum()).astype(np.float32)
    return Weights(bias, np.zeros((buckets, CLASSES), np.float32), np.zeros(buckets, np.float32))


class Batch(NamedTuple):
    """Texts one after the other: their distinct words, and for each token its word, class, features."""

    words: np.ndarray  # of bytes
    token: np.ndarray
    classes: np.ndarray
    buckets: np.ndarray  # (FEATURES, tokens)
    lengths: np.ndarray


def batch_of(
    split: list[list[bytes]], kinds: Classes, buckets: int = LEAST_BUCKETS, before: list[list[bytes]] | None = None
) -> Batch:
    """`before` has the words, `REACH` at most, that stand before each of the texts."""
    own = None
    if before and any(before):
        own = np.concatenate([np.arange(len(b) + len(x)) >= len(b) for b, x in zip(before, split)])
        split = [b + x if b else x for b, x in zip(before, split)]
    lengths = np.array([len(x) for x in split], np.int64)
    flat = pa.array(list(chain.from_iterable(split)), pa.large_binary())
    coded = flat.dictionary_encode()
    words, token = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
    hashes = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))[token]
    classes = kinds.of_all(coded.dictionary)[token]
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)

    def earlier(x: np.ndarray, by: int, outside: int) -> np.ndarray:
        out = np.full(len(x), outside, np.uint32)
        out[by:] = x[: max(len(x) - by, 0)]
        out[place < by] = outside
        return out

    one, two, three = (earlier(hashes, k, _BEFORE) for k in (1, 2, 3))
    near, far = (earlier(classes, k, CLASSES) for k in (1, 2))
    mixed = np.stack([
        one * _MIX[0],  # the word before
        (one * np.uint32(31) + two) * _MIX[1] + np.uint32(1),  # the two words before
        two * _MIX[2] + np.uint32(2),  # one word skipped
        three * _MIX[3] + np.uint32(3),  # two words skipped
        (near * np.uint32(CLASSES + 1) + far + np.uint32(7)) * _MIX[4],  # the classes of the two before
    ])
    mixed ^= mixed >> np.uint32(15)
    mixed *= _MIX[1]
    mixed >>= np.uint32(33 - buckets.bit_length())
    if own is not None:
        token, classes, mixed = token[own], classes[own], mixed[:, own]
        lengths = lengths - np.array([len(b) for b in before], np.int64)
    return Batch(words, token, classes, mixed, lengths)


def _sums(weights: Weights, buckets: np.ndarray) -> np.ndarray:
    """What speaks for each class: (tokens, CLASSES). Bounded, so that its exponential is finite."""
    logits = weights.table.take(buckets[0], axis=0)
    for row in buckets[1:]:
        logits += weights.table.take(row, axis=0)
    logits += weights.bias
    return np.minimum(logits, 80, out=logits)


def shares(weights: Weights, buckets: np.ndarray) -> np.ndarray:
    """All classes' probabilities: (tokens, CLASSES)."""
    out = _sums(weights, buckets)
    np.exp(out, out=out)
    out /= out.sum(axis=1, keepdims=True)
    return out


class Factors(NamedTuple):
    """Weights as what they multiply a class's odds by: scoring then takes no exponentials."""

    bias: np.ndarray
    table: np.ndarray


def for_scoring(weights: Weights) -> Weights | Factors:
    """Factors, unless the weights are so large that a product of them may leave the range of its type."""
    if np.abs(weights.table).max(initial=0) * FEATURES > LARGEST_SUM:
        return weights
    return Factors(weights.bias, np.exp(weights.table))


def log10_class(weights: Weights | Factors, batch: Batch) -> np.ndarray:
    """Of each token, log10 of its class's probability after what stands before it."""
    out = np.empty(len(batch.token))
    for at in range(0, len(out), STEP_TOKENS):
        part = slice(at, at + STEP_TOKENS)
        buckets, classes = batch.buckets[:, part], batch.classes[part]
        if isinstance(weights, Factors):
            odds = weights.table.take(buckets[0], axis=0)
            for row in buckets[1:]:
                odds *= weights.table.take(row, axis=0)
            chosen = np.log(odds[np.arange(len(odds)), classes].astype(np.float64)) + weights.bias[classes]
            out[part] = chosen - np.log(odds @ np.exp(weights.bias))
        else:
            logits = _sums(weights, buckets)
            chosen = logits[np.arange(len(logits)), classes].astype(np.float64)
            out[part] = chosen - np.log(np.exp(logits, out=logits).sum(axis=1))
    return out / np.log(10)


def _distinct(buckets: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct buckets, most frequent first; how often each occurs, the tokens ordered by bucket, and
    the place of each (feature, token) among the distinct buckets."""
    flat = buckets.reshape(-1)
    counts = np.bincount(flat, minlength=most)
    touched = np.flatnonzero(counts)
    # numpy sorts numbers of 16 bits by their digits.
    small = np.uint16 if len(flat) <= 1 << 16 else np.uint32
    touched = touched[np.argsort((len(flat) - counts[touched]).astype(small), kind="stable")]
    rank = np.empty(most, small)
    rank[touched] = np.arange(len(touched))
    place = rank[flat]
    return touched, counts[touched], place.argsort(kind="stable") % buckets.shape[1], place.reshape(buckets.shape)


def _gradient(error: np.ndarray, times: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Of each distinct bucket, as `_distinct` orders them, the sum of its tokens' errors."""
    starts = np.cumsum(times) - times
    out = error.take(tokens[starts], axis=0)
    # Buckets that occur often one by one, all others at once: their second tokens, their third and so on.
    often = int(np.count_nonzero(times > OFTEN))
    for k in range(often):
        out[k] = error.take(tokens[starts[k] : starts[k] + times[k]], axis=0).sum(axis=0, dtype=np.float64)
    for k in range(1, OFTEN):
        more = int(np.count_nonzero(times > k))
        out[often:more] += error.take(tokens[starts[often:more] + k], axis=0)
    return out


def learn(weights: Weights, batch: Batch) -> None:
    """Gradient steps over the batch, in place; each feature's rate falls with what it has seen."""
    for at in range(0, len(batch.token), STEP_TOKENS):
        part = slice(at, at + STEP_TOKENS)
        # Only the buckets of these tokens move, and they are fetched once.
        touched, times, tokens, place = _distinct(batch.buckets[:, part], len(weights.table))
        own = Weights(weights.bias, weights.table.take(touched, axis=0), weights.seen[touched])
        error = shares(own, place)
        error[np.arange(len(error)), batch.classes[part]] -= 1
        gradient = _gradient(error, times, tokens)
        seen = own.seen + np.einsum("ij,ij->i", gradient, gradient)
        gradient *= (RATE / np.sqrt(seen + 1.0))[:, None]
        weights.seen[touched] = seen
        weights.table[touched] = np.subtract(own.table, gradient, out=gradient)
