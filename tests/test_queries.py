import pytest

import __spark_entry__ as driver
from tests.oracle import compare, connect
from tickloom.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


# Many small jobs each, and nothing that the other queries don't run in both sessions.
BY_HOUR = {"land_hour", "hourly_batch_hours"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, db, name):
    assert compare(driver.queries()[name](spark, SF_DIR), db, driver.oracle_sql()[name]) > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - BY_HOUR))
def test_query_in_another_session(spark, db, session_settings, name):
    session_settings(zone="America/New_York", ansi="false", adaptive="false")
    compare(driver.queries()[name](spark, SF_DIR), db, driver.oracle_sql()[name])
