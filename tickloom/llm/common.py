"""What the operators share: table access, patterns, written intermediate tables, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.scratch import fresh_path

#: White space between words, and a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_crc32(name: str = "doc_id") -> Column:
    """The crc32 of an id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared scratch folder: it outlives lost executors, and its size is known.

    The result of an operator may still read it, so it stays until the folder is cleared.
    """
    spark = df.sparkSession
    path = fresh_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that `df` doesn't have, whatever its case."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
