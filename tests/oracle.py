"""Comparison of a Spark result with the rows of a DuckDB query."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, db, sql):
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    assert sum(actual.values()) == sum(expected.values())
    assert actual == expected, list((actual - expected).items())[:2] + list(
        (expected - actual).items()
    )[:2]
    return sum(actual.values())
