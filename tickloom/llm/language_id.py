"""Language ID by a bidirectional gated recurrent network over bytes.

The UTF-8 bytes of a text are cut into windows of `WINDOW` bytes. In each window one network reads
forwards and one backwards; at every position both states give a probability per language, and a
document's probabilities are the means over all its positions. Every byte of every text is read.

The network is trained in numpy by backpropagation through time, on the driver, from a bounded
sample: about `PER_LANGUAGE` documents of each language, drawn by a hash of id and text, and
`WINDOWS_PER_TEXT` windows at hashed places of each of them. Nothing else of the corpus is kept.

Defined cases: a text that is null or has no letter is `und` with score 0, and so is every text if
no labelled row can be learned from; rows without a language or text are not learned from; a
single learned language is given to all texts with letters; rows equal in id and text are learned from
once; of equally likely languages the first by name is given; an empty table gives an empty result; other
columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_names, id_crc32, text_or_empty, written

UNKNOWN = "und"
LETTER = r"\p{L}"
WINDOW, UNITS = 64, 8
#: The bound of the training sample.
PER_LANGUAGE, WINDOWS_PER_TEXT = 400, 6
#: Texts, and bytes of them, that are put through the network together; one text is never divided.
TEXTS_AT_ONCE, BYTES_AT_ONCE = 500, 1 << 23
STEPS, BATCH, RATE = 240, 256, 0.03
#: Windows that run through the network at a time.
AT_ONCE = 4096
#: Rows with this remainder of the id's crc32 by FOLDS are held out.
FOLDS, HELD_OUT = 4, 2
_PAD = 32


class Network(NamedTuple):
    """Weights: per direction the gates' inputs by byte, their recurrence and bias; the output layer."""

    languages: list[str]
    inputs: list[np.ndarray]  # (256, 3 * units): update, reset, candidate
    recur: list[np.ndarray]  # (units, 3 * units)
    out: np.ndarray  # (2 * units, languages)
    bias: np.ndarray  # (languages,)


def held_out(id: str = "doc_id") -> Column:
    return id_crc32(id) % FOLDS == HELD_OUT


def _states(windows: np.ndarray, inputs: np.ndarray, recur: np.ndarray, gates: list | None = None) -> np.ndarray:
    """The state after each position: (positions, windows, units). `gates` gets what training needs."""
    length, count = windows.shape
    units = recur.shape[0]
    h = np.zeros((count, units), np.float32)
    states = np.empty((length, count, units), np.float32)
    both, cand = np.ascontiguousarray(recur[:, : 2 * units]), np.ascontiguousarray(recur[:, 2 * units :])
    for t in range(length):
        x = inputs[windows[t]]
        zr = x[:, : 2 * units] + h @ both
        zr *= 0.5
        np.tanh(zr, out=zr)  # the logistic function, by the faster tanh
        zr += 1
        zr *= 0.5
        z, r = zr[:, :units], zr[:, units:]
        u = h @ cand
        n = np.tanh(x[:, 2 * units :] + r * u)
        if gates is not None:
            gates.append((h, z, r, n, u))
        h = n + z * (h - n)
        states[t] = h
    return states


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


def _position_probabilities(windows: np.ndarray, net: Network) -> np.ndarray:
    """(positions, windows, languages) for windows given as (positions, windows) bytes."""
    units = net.recur[0].shape[0]
    forward = _states(windows, net.inputs[0], net.recur[0])
    backward = _states(windows[::-1], net.inputs[1], net.recur[1])[::-1]
    logits = forward @ net.out[:units]
    logits += backward @ net.out[units:]
    logits += net.bias
    return _softmax(logits)


def text_probabilities(texts: list[bytes], net: Network) -> np.ndarray:
    """(texts, languages): the mean over each text's positions; empty texts get zeros."""
    counts = np.array([-(-len(x) // WINDOW) for x in texts], np.int64)
    total = np.zeros((len(texts), len(net.languages)))
    owner = np.repeat(np.arange(len(texts)), counts)
    flat = b"".join(x + bytes([_PAD]) * (-len(x) % WINDOW) for x in texts)
    rows = np.frombuffer(flat, np.uint8).reshape(-1, WINDOW)
    # Positions of the text in each of its windows.
    valid = np.full(len(rows), WINDOW, np.int64)
    ends = np.cumsum(counts)
    some = counts > 0
    lengths = np.array([len(x) for x in texts], np.int64)
    valid[ends[some] - 1] = lengths[some] - (counts[some] - 1) * WINDOW
    for at in range(0, len(rows), AT_ONCE):
        part = np.ascontiguousarray(rows[at : at + AT_ONCE].T)
        probabilities = _position_probabilities(part, net)
        inside = np.arange(WINDOW)[:, None] < valid[at : at + AT_ONCE]
        if not inside.all():
            probabilities *= inside[:, :, None]
        sums = probabilities.sum(axis=0, dtype=np.float64)
        np.add.at(total, owner[at : at + AT_ONCE], sums)
    return total / np.maximum(lengths, 1)[:, None]


def _gradients(windows: np.ndarray, wanted: np.ndarray, net: Network) -> list[np.ndarray]:
    """Of the mean cross entropy over all positions: inputs and recurrence per direction, out, bias."""
    length, count = windows.shape
    units = net.recur[0].shape[0]
    orders = (windows, windows[::-1])
    gates: list[list] = [[], []]
    states = [_states(w, net.inputs[d], net.recur[d], gates[d]) for d, w in enumerate(orders)]
    both = np.concatenate([states[0], states[1][::-1]], axis=2)
    error = _softmax(both @ net.out + net.bias)
    error[:, np.arange(count), wanted] -= 1
    error /= length * count
    flat = error.reshape(-1, error.shape[2])
    d_out, d_bias = both.reshape(-1, 2 * units).T @ flat, flat.sum(axis=0)
    d_both = error @ net.out.T
    found = []
    for d, order in enumerate(orders):
        arriving = d_both[:, :, :units] if d == 0 else d_both[::-1, :, units:]
        inputs, recur = np.zeros_like(net.inputs[d]), np.zeros_like(net.recur[d])
        dh = np.zeros((count, units), np.float32)
        pre = np.empty((length, count, 3 * units), np.float32)
        for t in range(length - 1, -1, -1):
            h, z, r, n, u = gates[d][t]
            dh = dh + arriving[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * u * r * (1 - r)
            pre[t, :, :units], pre[t, :, units : 2 * units], pre[t, :, 2 * units :] = dz, dr, dn
            through = np.concatenate([dz, dr, dn * r], axis=1)
            recur += h.T @ through
            dh = dh * z + through @ net.recur[d].T
        # The gates' inputs by byte: rows summed in the order of bytes.
        bytes_, rows = order.reshape(-1), pre.reshape(-1, 3 * units)
        in_order = np.argsort(bytes_, kind="stable")
        seen, first = np.unique(bytes_[in_order], return_index=True)
        inputs[seen] = np.add.reduceat(rows[in_order], first, axis=0)
        found += [inputs, recur]
    return [*found, d_out, d_bias]


def train(windows: np.ndarray, wanted: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """A network for windows (windows, positions) and the numbers of their languages; Adam steps."""
    random = np.random.default_rng(seed)
    scale = lambda *shape: (random.standard_normal(shape) * 0.3).astype(np.float32)
    weights = [
        scale(256, 3 * UNITS), scale(UNITS, 3 * UNITS), scale(256, 3 * UNITS), scale(UNITS, 3 * UNITS),
        scale(2 * UNITS, len(languages)), np.zeros(len(languages), np.float32),
    ]
    network = lambda: Network(languages, weights[0:4:2], weights[1:4:2], weights[4], weights[5])
    mean, spread = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    by_language = [np.flatnonzero(wanted == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        # As many windows of each language.
        chosen = np.concatenate([random.choice(x, -(-BATCH // len(by_language))) for x in by_language])
        found = _gradients(np.ascontiguousarray(windows[chosen].T), wanted[chosen], network())
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in enumerate(found):
            mean[k] += 0.1 * (g - mean[k])
            spread[k] += 0.01 * (g * g - spread[k])
            change = mean[k] / (1 - 0.9**step) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-8)
            weights[k] = (weights[k] - rate * change).astype(np.float32)
    return network()


def sample_windows(docs: DataFrame, id: str, text: str, lang: str) -> pd.DataFrame:
    """lang, window: the bounded sample of the rows that may be learned from."""
    labelled = docs.where(~held_out(id) & F.col(lang).isNotNull() & F.col(text).rlike(LETTER)).select(
        F.col(lang).alias("lang"), F.col(id).cast("string").alias("id"), F.col(text).alias("content")
    )
    labelled = labelled.withColumn("key", F.xxhash64("id", "content", F.lit("language-sample")))
    # Different documents, within a fiftieth: copies of one text must not stand for a language.
    sizes = written(labelled.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n")), "languages")
    coin = F.pmod("key", F.lit(1 << 40)) / float(1 << 40)
    drawn = labelled.join(sizes, "lang").where(coin < F.lit(1.1 * PER_LANGUAGE) / F.col("n"))
    drawn = drawn.dropDuplicates(["lang", "key"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for language, key, content in zip(batch["lang"], batch["key"].tolist(), batch["content"]):
                data = content.encode("utf-8")
                random = np.random.default_rng([key & 0xFFFFFFFF, key >> 32 & 0xFFFFFFFF])
                for at in random.integers(0, max(1, len(data) - WINDOW + 1), WINDOWS_PER_TEXT):
                    rows.append((language, data[at : at + WINDOW].ljust(WINDOW, bytes([_PAD]))))
            yield pd.DataFrame(rows, columns=["lang", "window"])

    found = drawn.mapInPandas(cut, "lang string, window binary").toPandas()
    return found.sort_values(["lang", "window"], ignore_index=True)


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """The network, or None if there is nothing to learn from."""
    sample = sample_windows(docs, id, text, lang)
    if not len(sample):
        return None
    languages = sorted(set(sample["lang"]))
    wanted = np.searchsorted(languages, sample["lang"].to_numpy(str))
    windows = np.frombuffer(b"".join(map(bytes, sample["window"])), np.uint8).reshape(-1, WINDOW)
    return train(windows, wanted, languages)


def _together(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if len(group) == TEXTS_AT_ONCE or held >= BYTES_AT_ONCE:
            yield group
            group, held = [], 0
    if group:
        yield group


def identify(docs: DataFrame, net: Network | None, text: str = "text") -> tuple[DataFrame, str, str]:
    """`docs` with a predicted language and its score, and the names of these columns."""
    lang_pred, score, guess = free_names(docs, "lang_pred", "score", "language_guess")
    if net is None:
        return docs.select("*", F.lit(UNKNOWN).alias(lang_pred), F.lit(0.0).alias(score)), lang_pred, score

    @F.pandas_udf("lang string, score double")
    def guessed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in texts:
            best, scores = [], []
            for group in _together(x.encode("utf-8") for x in some):
                part = text_probabilities(group, net)
                best += [net.languages[k] for k in part.argmax(axis=1)]
                scores += part.max(axis=1).tolist()
            yield pd.DataFrame({"lang": best, "score": np.clip(scores, 0.0, 1.0)})

    # Not evaluated again where its result is used.
    guesses = docs.select("*", guessed.asNondeterministic()(text_or_empty(text)).alias(guess))
    known = F.coalesce(F.col(text).rlike(LETTER), F.lit(False))
    named = guesses.select(
        "*",
        F.when(known, F.col(guess)["lang"]).otherwise(UNKNOWN).alias(lang_pred),
        F.when(known, F.col(guess)["score"]).otherwise(0.0).alias(score),
    )
    return named.drop(guess), lang_pred, score


def keep_identified(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of `docs` that have a language, however low its score is, with their columns."""
    named, lang_pred, score = identify(docs, fit(docs, id, text, lang), text)
    return named.where(F.col(lang_pred) != UNKNOWN).drop(lang_pred, score)
