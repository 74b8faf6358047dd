"""Every registered query against DuckDB on the smallest tables.

The queries share one logbook and one plan here, so that each table is made once.
"""

import functools
import os

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from workloads import queries
from workloads.oracles import oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module", autouse=True)
def shared_plan(spark):
    logbook = functools.cache(lambda sf_dir: queries.Logbook(spark, sf_dir))
    feed = functools.cache(lambda sf_dir: queries.FeedPlan.of(logbook(sf_dir).plan, queries.FEED))
    patch = pytest.MonkeyPatch()
    patch.setattr(queries, "_logbook", lambda make: lambda spark, sf_dir: make(logbook(sf_dir)))
    patch.setattr(queries, "_archive", lambda make: lambda spark, sf_dir: make(logbook(sf_dir).plan))
    patch.setattr(queries, "_feed", lambda make: lambda spark, sf_dir: make(feed(sf_dir)))
    yield
    patch.undo()


def test_every_query_has_a_check():
    assert set(queries.registry()) == set(oracles())


@pytest.mark.parametrize("key", list(queries.registry()))
def test_query(spark, con, key):
    query = contract.queries()[key]
    assert difference(query(spark, SF_DIR), con, contract.oracle_sql()[key]) is None


def test_entry_gives_one_row(spark):
    assert contract.entry(spark).count() == 1
