"""Every registered query over whole small tables, against its SQL or the plain version of its operator."""

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.helpers import awkward, empty
from tests.oracle import compare, connect
from tickloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROWS = {"op2_html_text": "pages"}


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, db, name):
    assert compare(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_a_row_per_row(spark, name):
    source = spark.read.parquet(f"{SF_DIR}/{ROWS.get(name, 'documents')}.parquet")
    assert QUERIES[name](spark, SF_DIR).count() == source.count()


def test_all_are_registered():
    names = driver.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLES) <= set(driver.oracle_sql())


def test_pipeline_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    counts = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        out = stage(spark, docs, SF_DIR)
        if number < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        docs = out
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] > 0 and counts[3] == counts[4]
    rows = docs.collect()
    assert all(r.decoded == texts[r.doc_id] for r in rows)


@pytest.mark.parametrize("make", [awkward, empty])
def test_pipeline_stages_take_awkward_tables(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() >= 0
