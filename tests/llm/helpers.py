"""What the tests of the operators share: small tables with every awkward row, plain reference versions."""

import re

from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that operators use for columns of their own.
    *(T.StructField(name, T.StringType()) for name in ("Size", "copies", "hash", "fp", "row_id", "score", "rank")),
])
LONG = "the thin line " * 30_000
AWKWARD = [
    (1, "Some words of a text, and more of them.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n\x0b ", "de", "b"),
    (5, "Some words of a text, and more of them.", "en", "a"),
    (5, "Some words of a text, and more of them.", "en", "a"),
    (6, "Some  words of a text,\nand more of them. ", "en", ""),
    (7, LONG, "en", "b"),
    (8, "ÄÖÜ straße 漢字 \U0001f600 é İ ﬁ 'tis it's", "de", "ß"),
    (None, "no id at all", "en", None),
    (9, "123 456 !?", "fr", "b"),
    (100, "one", "en", "a"),
    (200, "two words", "en", "a"),
    (300, "<|endoftext|> a # b", "en", "a"),
]


def awkward(spark):
    rows = [(i, t, g, s, len(t or ""), *("x" * 7)) for i, t, g, s in AWKWARD]
    return spark.createDataFrame(rows, DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def words(text):
    """Words with A-Z in lower case."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)
