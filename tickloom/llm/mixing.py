"""Mixing sources to target weights, by repetition rates and one seeded coin per document.

The size of a document is its number of words. Sources stand in order of code point, null last,
and weigh 1, 2, 3, 1, 2, 3, … A source's target is its share of all words, by weight, but at most
`MOST` times its own size; what is over is shared again by weight among the others until none is
above. A document is emitted floor(rate) times, and once more if the hash of the seed, its id and its
text falls below the rate's fraction: reruns agree, and each source's words come near its target, also
where rows share an id or have none.

Defined cases: a null text has no words; a null source is a source of its own; a source without
words has rate 0, so its documents are not emitted; rows equal in id and text share one coin; no
documents, or no words at all, give no copies. Other columns are kept as they are.

One row per source is all that meets in one task. It is written, so Spark knows its size: it sends
the rates to every task if they are few and joins by shuffle, split where skewed, otherwise. The
words per source are summed before the shuffle, so a hot source is no hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, free_names, text_or_empty, written

#: No source is taken more often than this.
MOST = 3
#: Weights by the rank of the source, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Hex digits of the coin's hash, and their range.
_DIGITS, _RANGE = 13, float(16**13)


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, weight, target of rows with source and size.

    The sources that reach their bound are those with the least room per weight. If the first i of
    them are filled, the rest gets `level` per unit of weight. That is highest where the sharing
    comes to rest, so the highest level is the one that holds.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    kind = (F.row_number().over(in_order) - 1) % len(WEIGHTS)
    weighed = totals.select("*", F.element_at(F.array(*map(F.lit, WEIGHTS)), kind + 1).alias("weight"))
    room = weighed.select("*", (F.col("source_size") * MOST).alias("bound"))
    by_room = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = F.coalesce(F.sum("bound").over(before), F.lit(0))
    passed = F.coalesce(F.sum("weight").over(before), F.lit(0))
    left = (F.sum("source_size").over(everything) - filled).cast("double")
    levels = room.select("*", (left / (F.sum("weight").over(everything) - passed)).alias("level"))
    top = F.max("level").over(everything)
    return levels.select(
        "source",
        "source_size",
        "weight",
        F.least(F.col("bound").cast("double"), top * F.col("weight")).alias("target"),
    )


def with_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED
) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with its size, its source's size and target, and the copies to emit.

    The second value names these columns: `size`, `source_size`, `target`, `copies`, unless `docs`
    has such names already.
    """
    size, source_size, target, copies, key = free_names(
        docs, "size", "source_size", "target", "copies", "mix_source"
    )
    sizes = docs.select(F.col(source).alias("source"), word_count(text).alias("size"))
    rates = written(source_targets(sizes), "mix-rates").select(
        F.col("source").alias(key),
        F.col("source_size").alias(source_size),
        F.col("target").alias(target),
    )
    sized = docs.select("*", word_count(text).alias(size))
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    drawn_by = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit("")), F.md5(text_or_empty(text)))
    digits = F.substring(F.md5(drawn_by), 1, _DIGITS)
    coin = F.conv(digits, 16, 10).cast("double") / F.lit(_RANGE)
    emitted = (F.floor(rate) + F.when(coin < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    mixed = sized.join(rates, sized[source].eqNullSafe(rates[key])).drop(key)
    names = {"size": size, "source_size": source_size, "target": target, "copies": copies}
    return mixed.select("*", emitted.alias(copies)), names


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED
) -> DataFrame:
    """The mix: every row of `docs` as often as it is emitted, with its own columns."""
    counted, names = with_copies(docs, id, text, source, seed)
    (nth,) = free_names(counted, "nth_copy")
    copies = F.col(names["copies"])
    many = counted.where(copies > 0).select("*", F.explode(F.sequence(F.lit(1), copies)).alias(nth))
    return many.drop(nth, *names.values())
