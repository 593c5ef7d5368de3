"""Exact dedup: rows grouped by a 128-bit content hash, with the bytes compared inside each group.

Texts are equal when they are identical without the characters of `SPACE`. A null text is the
empty text. Of equal texts the row with the most code points stays, then the one with the smallest
id; a null id comes last. Of rows that agree in all of this, any one stays. An empty table gives an empty result, and other columns are never read.

The aggregate keeps hash and text as its key, so two texts are joined only if their bytes agree,
and copies collapse before the shuffle: a group of any size leaves one row per task. Rows find
their group in a join that adaptive execution can split, since both of its sides are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE, free_names, text_or_empty, written
from tickloom.operators.membership import may_be_in


def _bare(text: str) -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE + "+", "")


def exact_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_chars, keep_id, group_size, kept, text_sha256.

    `digest` is the content hash; a weak one costs time and changes nothing.
    """
    bare = docs.select(
        F.col(id).alias("doc_id"),
        F.length(text_or_empty(text)).cast("long").alias("n_chars"),
        _bare(text).alias("bare"),
    )
    rows = bare.select(
        "doc_id",
        "n_chars",
        F.struct(
            (-F.col("n_chars")).alias("longest"), F.col("doc_id").isNull().alias("no_id"), "doc_id"
        ).alias("place"),
        digest(F.col("bare")).alias("hash"),
        F.sha2("bare", 256).alias("text_sha256"),
        "bare",
    )
    groups = (
        rows.groupBy("hash", "bare")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("bare", 256).alias("text_sha256"), "first", "group_size")
    )
    # The second digest tells texts apart that share the first.
    found = rows.drop("bare").join(groups, ["hash", "text_sha256"]).select(
        "doc_id",
        "n_chars",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("place") == F.col("first")).alias("first"),
        "text_sha256",
        "hash",
        F.monotonically_increasing_id().alias("row"),
    )
    # Written, so that a row keeps its number; without the texts.
    found = written(found, "exact-groups")
    tied = found.where("first").groupBy("hash", "text_sha256").agg(
        F.min("row").alias("stays"), F.count(F.lit(1)).alias("ties")
    )
    tied = tied.where("ties > 1").drop("ties")
    return found.join(tied, ["hash", "text_sha256"], "left").select(
        "doc_id",
        "n_chars",
        "keep_id",
        "group_size",
        (F.col("first") & (F.col("row") == F.coalesce("stays", "row"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Only the keys of groups with dropped rows meet the texts. A Bloom filter of them, as long as they are
    few enough for one, lets all other rows pass where they are read, so that texts are shuffled in
    proportion to the copies; beyond that all rows meet the keys.
    """
    sha, n_chars, row_id = names = free_names(docs, "text_sha256", "n_code_points", "row_id")
    keyed = docs.select(
        "*",
        F.sha2(_bare(text), 256).alias(sha),
        F.length(text_or_empty(text)).cast("long").alias(n_chars),
        F.col(id).alias(row_id),
    )
    gone = exact_groups(docs, id, text).groupBy("text_sha256", "n_chars", "doc_id").agg(
        F.max("kept").alias("kept"), F.min("kept").alias("all")
    )
    gone = written(gone.where(~F.col("all")), "copies")
    one_each = gone.where("kept")  # rows that go are tied with the one that stays

    likely = may_be_in(
        gone.select(F.col("text_sha256").alias(sha), F.col("n_chars").alias(n_chars), F.col("doc_id").alias(row_id)),
        names,
        gone.count(),
    )
    # A row that is not in the filter has no copy that stays in its place.
    asked = keyed if likely is None else keyed.where(likely)

    def match(some: DataFrame) -> Column:
        return (
            (asked[sha] == some["text_sha256"])
            & (asked[n_chars] == some["n_chars"])
            & asked[row_id].eqNullSafe(some["doc_id"])
        )

    kept = asked.join(gone, match(gone), "left_anti")
    if likely is not None:
        kept = kept.unionByName(keyed.where(~likely))
    if not one_each.isEmpty():
        kept = kept.unionByName(asked.join(one_each, match(one_each), "left_semi").dropDuplicates(names))
    return kept.drop(*names)
