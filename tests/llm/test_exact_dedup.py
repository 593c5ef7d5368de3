import hashlib
import re

from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, awkward, empty
from tickloom.llm.exact_dedup import drop_copies, exact_groups


def plain(rows):
    groups = {}
    for id_, text, *_ in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(bare, []).append((-len(text or ""), id_ is None, id_ or 0, id_))
    out = []
    for id_, text, *_ in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[bare])
        own = (-len(text or ""), id_ is None, id_ or 0, id_)
        out.append((id_, best[3], len(groups[bare]), own == best, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    rows = df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_groups_match_a_plain_version(spark):
    assert found(exact_groups(awkward(spark))) == plain(AWKWARD)


def test_a_weak_hash_changes_nothing(spark):
    for weak in (lambda c: F.substring(F.md5(c), 1, 1), lambda c: F.lit("same")):
        assert found(exact_groups(awkward(spark), digest=weak)) == plain(AWKWARD)


def test_dropping_keeps_one_document_of_each_group_with_its_columns(spark):
    docs = awkward(spark)
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    # 6 is the longest of the texts that are equal without white space, 4 of those that are blank.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([6, 4, 7, 8, None, 9, 100, 200, 300], key=str)


def test_rows_of_one_id_that_differ_only_in_blanks_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a  b"), (2, "ab")], "doc_id long, text string")
    assert [r.text for r in drop_copies(docs).collect()] == ["a  b"]


def test_empty_table(spark):
    assert exact_groups(empty(spark)).count() == 0 == drop_copies(empty(spark)).count()


def test_plan_has_no_python_and_collapses_copies_before_the_shuffle(spark):
    plan = exact_groups(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "partial_min" in plan


def test_one_of_repeated_keepers_and_of_rows_without_an_id_stays(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "a b"), (2, "ab"), (None, "x"), (None, "x"), (None, "x "), (None, "x "), (3, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(((r.doc_id, r.text) for r in drop_copies(docs).collect()), key=str) == [(1, "a b"), (3, "c"), (None, "x ")]
    groups = exact_groups(docs).collect()
    assert len(groups) == len(rows) and sorted(r.group_size for r in groups if r.kept) == [1, 4, 4]
