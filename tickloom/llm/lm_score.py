"""Language-model scores of whole texts by a hashed maximum-entropy model with word classes.

A token is a word between white space, A-Z in lower case, and one end per text. The model gives
log10 P(class | what stands before) + log10 P(word | class). The first is a softmax over classes
with hashed weights of n-grams and skip-grams; the second is the word's share of its class, each
count raised by a half, with a half for the one unknown word of each class. So the probabilities of
all words, known or not, sum to one after any context.

Words are counted over all texts that may be learned from. Training runs in rounds, each over its
own part of the texts, so that every text is learned from once: trainers take gradient steps from
the same weights, the weights they end with are averaged by tokens, and the next round starts from
the mean. Averages are summed in lanes, so no task gets the weights of all trainers. A task trains two of
them one after the other and sends one sum of their weights, which halves what is exchanged.

A word's count reaches the tokens in one of two ways. The words that make up a `1 / HEAVY` of all
tokens or more, `HEAVY` words at most and short, are sent to every task. All others are joined by
word, at most one row per text and word, so no key of that join holds more rows than that share.

Defined cases: a null text is the empty text, whose only token is the end; rows that repeat an id
or all of a row are scored, and learned from, each for itself; with nothing to learn from every
base score is 0 and every class as likely; no rows give none; other columns are not read. Texts of
more than `SEGMENT` words are read in segments of that many, each with the words before it as context.

Left out: P(word | class) has no weights of its own. What stands before tells classes apart, not the
words of one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import maxent
from tickloom.llm.common import id_crc32, text_or_empty, written
from tickloom.llm.maxent import Classes, Weights

#: Rows with this remainder of the id's crc32 by FOLDS are held out.
FOLDS, HELD_OUT = 5, 1
#: At most this many words are sent to all tasks, none longer than HEAVY_BYTES.
HEAVY, HEAVY_BYTES = 1 << 20, 64
#: A trainer's tokens: so many, and so many for each bucket if the buckets are many.
ROUNDS, TRAINER_TOKENS, BUCKET_TOKENS = 3, 5_000_000, 40
#: Trainers that a task runs, one after the other.
TRAINERS_A_TASK = 2
#: Words of a segment, and tokens that are worked on together.
SEGMENT, TOKENS_AT_ONCE = 200_000, 300_000
#: Words, repeats included, that a counting task holds.
COUNTED_AT_ONCE = 4_000_000
#: Texts that are split together when words are counted; their bytes if there are more than one, and those held.
TEXTS_AT_ONCE, BYTES_AT_ONCE = 1_000, 1 << 26
#: Buckets in one row of exchanged weights, and trainers whose rows one lane sums.
SLICE, LANE = 128, 64


def held_out(id: str = "doc_id") -> Column:
    return id_crc32(id) % FOLDS == HELD_OUT


def _segments(texts: Iterator[str]) -> Iterator[tuple[list[int], list[list[bytes]], list[list[bytes]]]]:
    """Groups of segments of words, with the place of each one's text and the words before it."""
    places, groups, before, held = [], [], [], 0
    for place, text in enumerate(texts):
        words = maxent.words_of(text)
        for at in range(0, len(words), SEGMENT):
            places.append(place)
            groups.append(words[at : at + SEGMENT] if len(words) > SEGMENT else words)
            before.append(words[max(at - maxent.REACH, 0) : at])
            held += len(groups[-1])
            if held >= TOKENS_AT_ONCE:
                yield places, groups, before
                places, groups, before, held = [], [], [], 0
    if groups:
        yield places, groups, before


def _runs(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts one after the other: TEXTS_AT_ONCE and BYTES_AT_ONCE at most, or a single longer one."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, min(at + TEXTS_AT_ONCE, int(np.searchsorted(ends, done + BYTES_AT_ONCE, "right"))))
        # Copies, for pyarrow's kernels on text misread some slices.
        yield texts.take(pa.array(np.arange(at, to)))
        at = to


def _words(texts: pa.Array) -> pa.Array:
    """The words of the texts, as `maxent.words_of` finds them, and an end for each text."""
    # These kernels know ASCII letters and white space only.
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts)).flatten().view(pa.binary())
    words = words.filter(pc.not_equal(words, pa.scalar(maxent.END, pa.binary())))
    return pa.concat_arrays([words, pa.array([maxent.END] * len(texts), pa.binary())])


def word_counts(learned: DataFrame) -> DataFrame:
    """word, n over all texts (`content`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def rows() -> pa.RecordBatch:
            counts = pa.chunked_array(held, pa.binary()).value_counts()
            held.clear()
            return pa.record_batch({"word": counts.field("values"), "n": counts.field("counts")})

        for batch in batches:
            for texts in _runs(batch["content"]):
                held.append(_words(texts))
                waiting += len(held[-1])
                if waiting >= COUNTED_AT_ONCE or sum(x.nbytes for x in held) >= BYTES_AT_ONCE:
                    yield rows()
                    waiting = 0
        if held:
            yield rows()

    partial = learned.mapInArrow(run, "word binary, n long")
    return written(partial.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def word_classes(counts: DataFrame) -> Classes:
    """The classes that the counts give; ties by bytes."""
    proper = counts.where(F.octet_length("word").between(1, HEAVY_BYTES))
    top = [bytes(r.word) for r in proper.orderBy(F.desc("n"), "word").limit(maxent.TOP_WORDS).collect()]

    @F.pandas_udf("binary")
    def ending(words):
        return pd.Series(maxent.endings_of(pa.array(words, pa.large_binary())).to_numpy(zero_copy_only=False))

    other = counts.where((F.octet_length("word") > 0) & ~F.col("word").isin([bytearray(w) for w in top]))
    endings = other.groupBy(ending("word").alias("ending")).agg(F.sum("n").alias("n"))
    most = endings.orderBy(F.desc("n"), "ending").limit(maxent.TOP_ENDINGS).collect()
    return maxent.classes_of(top, [bytes(r.ending) for r in most])


def class_sizes(counts: DataFrame, kinds: Classes) -> np.ndarray:
    """Of each class, its tokens and half a token for each of its words and its unknown word."""

    @F.pandas_udf("int")
    def kind(words):
        return pd.Series(kinds.of_all(pa.array(words, pa.large_binary())))

    sizes = np.full(maxent.CLASSES, 0.5)
    of_class = counts.groupBy(kind("word").alias("kind")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    for r in of_class.collect():
        sizes[r.kind] += r.n + 0.5 * r.v
    return sizes


def _summed(rows: DataFrame) -> DataFrame:
    """Rows of a slice and lane added up; a task holds one row for each of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                held = sums.setdefault((r["slice"], r["lane"]), [0, 0.0])
                held[0] += r["tokens"]
                held[1] = held[1] + np.frombuffer(r["weights"], np.float32)
        for (number, lane), (tokens, values) in sums.items():
            yield pa.RecordBatch.from_pylist(
                [{"slice": number, "lane": lane, "tokens": tokens, "weights": values.tobytes()}], _SLICES
            )

    return rows.repartition("slice", "lane").mapInArrow(run, _SLICE_COLUMNS)


_SLICE_COLUMNS = "slice int, lane int, tokens long, weights binary"
_SLICES = pa.schema([("slice", pa.int32()), ("lane", pa.int32()), ("tokens", pa.int64()), ("weights", pa.binary())])


def _train_round(
    part: DataFrame, kinds: Broadcast, start: Broadcast, tasks: int, turn: float = np.inf
) -> Weights | None:
    """The mean of the trainers' weights, or None if there was nothing to learn from.

    After `turn` tokens a task's next trainer takes over, the last of them keeps what is left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bias, table, seen = start.value
        own, before_own = Weights(bias, table.copy(), seen.copy()), None
        tokens, done, turns, lane = 0, 0, 1, TaskContext.get().partitionId() // LANE

        def summed() -> Weights:
            """What the trainers before this one, and this one, end with, each times its tokens."""
            for values in (own.table, own.seen):
                values *= np.float32(tokens)
            if before_own:
                np.add(own.table, before_own.table, out=own.table)
                np.add(own.seen, before_own.seen, out=own.seen)
            return own

        for batch in batches:
            for _, groups, before in _segments(batch["content"].to_pylist()):
                if tokens >= turn and turns < TRAINERS_A_TASK:
                    before_own, own = summed(), Weights(bias, table.copy(), seen.copy())
                    tokens, done, turns = 0, done + tokens, turns + 1
                some = maxent.batch_of(groups, kinds.value, len(table), before)
                maxent.learn(own, some)
                tokens += len(some.token)
        if not tokens:
            return
        found, done = summed(), done + tokens
        for at in range(0, len(table), SLICE):
            part = np.concatenate([found.table[at : at + SLICE], found.seen[at : at + SLICE, None]], axis=1)
            row = {"slice": at, "lane": lane, "tokens": done, "weights": part.tobytes()}
            yield pa.RecordBatch.from_pylist([row], _SLICES)

    rows = part.coalesce(tasks).mapInArrow(run, _SLICE_COLUMNS)
    lanes = -(-tasks // LANE)
    while lanes > 1:
        rows = _summed(rows).withColumn("lane", F.floor(F.col("lane") / LANE).cast("int"))
        lanes = -(-lanes // LANE)
    found = _summed(rows).toArrow()
    if not len(found):
        return None
    # Slice by slice into their places, so that the weights are held once.
    bias, table, seen = start.value
    mean = Weights(bias, np.empty_like(table), np.empty_like(seen))
    for batch in found.to_batches():
        for at, tokens, raw in zip(*(batch.column(c) for c in ("slice", "tokens", "weights"))):
            both = np.frombuffer(raw.as_buffer(), np.float32).reshape(SLICE, -1) / np.float32(tokens.as_py())
            mean.table[at.as_py() : at.as_py() + SLICE] = both[:, :-1]
            mean.seen[at.as_py() : at.as_py() + SLICE] = both[:, -1]
    return mean


def train(
    learned: DataFrame, kinds: Classes, sizes: np.ndarray, tokens: int, buckets: int = maxent.LEAST_BUCKETS
) -> Weights:
    """The weights after one pass over the texts (`content`, `round`)."""
    context = learned.sparkSession.sparkContext
    weights, shared = maxent.no_weights(sizes, buckets), context.broadcast(kinds)
    # What trainers exchange stays in proportion to what they read.
    trainers = max(1, round(tokens / ROUNDS / max(TRAINER_TOKENS, BUCKET_TOKENS * buckets)))
    tasks = max(1, trainers // TRAINERS_A_TASK)
    turn = tokens / ROUNDS / (tasks * TRAINERS_A_TASK) if trainers > 1 else np.inf
    for number in range(ROUNDS):
        start = context.broadcast(weights)
        part = learned.where(F.col("round") == number).select("content")
        weights = _train_round(part, shared, start, tasks, turn) or weights
        # Nothing reads the weights of a finished round again.
        start.destroy()
    return weights


def heavy_words(counts: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """Words and their counts, as Arrow and numpy hold them; the last count, -1, is that of no word."""
    found = counts.select("word", "n").toArrow().combine_chunks()
    words = found.column("word").combine_chunks() if len(found) else pa.array([], pa.binary())
    return words.cast(pa.binary()), np.append(found.column("n").to_numpy().astype(np.int64), -1)


def _scores(rows: DataFrame, kinds: Broadcast, weights: Broadcast, heavy: Broadcast, sizes: np.ndarray) -> DataFrame:
    """Of each row its tokens, what the heavy words add, the class scores, and its other words."""
    log_sizes = np.log10(sizes)
    kept = [f for f in rows.schema.names if f != "content"]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy_words, heavy_counts = heavy.value
        for batch in batches:
            n = len(batch)
            tokens, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            classes, counted = np.zeros(n), np.zeros(n)
            found = []  # (place, word, n)
            for places, groups, before in _segments(batch["content"].to_pylist()):
                some = maxent.batch_of(groups, kinds.value, len(weights.value.table), before)
                owner = np.repeat(np.array(places), some.lengths)
                by_text = maxent.log10_class(weights.value, some) - log_sizes[some.classes]
                distinct = pa.array(some.words, pa.binary())
                at = pc.index_in(distinct, heavy_words).fill_null(-1).to_numpy()
                counts = heavy_counts[at][some.token]
                is_heavy = counts >= 0
                tokens += np.bincount(owner, minlength=n)
                classes += np.bincount(owner, by_text, n)
                known += np.bincount(owner[is_heavy], minlength=n)
                counted += np.bincount(owner[is_heavy], np.log10(counts[is_heavy] + 0.5), n)
                pairs, times = np.unique(
                    owner[~is_heavy].astype(np.int64) * len(some.words) + some.token[~is_heavy], return_counts=True
                )
                words = distinct.take(pa.array(pairs % max(len(some.words), 1)))
                found.append((pairs // max(len(some.words), 1), words, times))
            place = np.concatenate([np.zeros(0, np.int64), *(x[0] for x in found)])
            words = pa.concat_arrays([pa.array([], pa.binary()), *(x[1] for x in found)])
            times = np.concatenate([np.zeros(0, np.int64), *(x[2] for x in found)])
            ends = np.searchsorted(place, np.arange(n + 1)).astype(np.int32)
            others = pa.ListArray.from_arrays(
                pa.array(ends), pa.StructArray.from_arrays([words, pa.array(times, pa.int64())], ["word", "times"])
            )
            columns = {name: batch[name] for name in kept}
            yield pa.RecordBatch.from_pydict(columns | {
                "n_tokens": pa.array(tokens), "heavy_known": pa.array(known), "class_score": pa.array(classes),
                "heavy_logs": pa.array(counted), "others": others,
            })

    return rows.mapInArrow(
        run,
        f"{types}, n_tokens long, heavy_known long, class_score double, heavy_logs double, "
        "others array<struct<word: binary, times: bigint>>",
    )


def score_texts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    context = docs.sparkSession.sparkContext
    learned = docs.where(~held_out(id)).select(
        text_or_empty(text).alias("content"),
        F.pmod(F.xxhash64(F.col(id).cast("string"), F.lit("round")), F.lit(ROUNDS)).alias("round"),
    )
    counts = word_counts(learned.select("content"))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    kinds = word_classes(counts)
    sizes = class_sizes(counts, kinds)
    weights = train(learned, kinds, sizes, total, maxent.buckets_for(distinct))

    is_heavy = (F.col("n") * HEAVY >= total) & (F.octet_length("word") <= HEAVY_BYTES)
    heavy = context.broadcast(heavy_words(counts.where(is_heavy)))
    rows = docs.select(
        F.col(id).alias("doc_id"),
        held_out(id).alias("held_out"),
        F.monotonically_increasing_id().alias("row"),
        text_or_empty(text).alias("content"),
    )
    scored = written(_scores(rows, context.broadcast(kinds), context.broadcast(maxent.for_scoring(weights)), heavy, sizes), "scores")
    other = scored.select("row", F.inline("others")).join(counts.where(~is_heavy), "word", "left")
    n = F.coalesce("n", F.lit(0))
    sums = other.groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("other_known"),
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("other_logs"),
    )
    logs = F.col("heavy_logs") + F.coalesce("other_logs", F.lit(0.0))
    whole = float(np.log10(total + 0.5 * (distinct + 1)))
    return scored.drop("others").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("heavy_known") + F.coalesce("other_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * whole).alias("base_score"),
        (logs + F.col("class_score")).alias("score"),
    )
