"""Every fixture query against its SQL oracle, over whole tables."""

import pytest

import __spark_entry__ as entry_points
from rowgate.plans import fixture_oracles, fixture_queries, fixture_routes
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_fixture_query_has_an_oracle():
    own = {**fixture_queries.queries(), **fixture_routes.queries()}
    assert set(own) == set({**fixture_oracles.oracle_sql(), **fixture_routes.oracle_sql()})
    assert set(own) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_fixture(spark, con, name):
    got, want, faults = compare(entry_points.queries()[name](spark, SF_DIR), con, entry_points.oracle_sql()[name])
    assert not faults
    assert got == want > 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["req_id", "status"]
