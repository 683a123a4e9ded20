"""Every registered query against its SQL in DuckDB, over whole tables."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, connect

from gaugeline.registered.oracles import ORACLES
from gaugeline.registered.queries import REGISTERED as QUERIES


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_matches_sql(spark, duck, small, name):
    problem = compare(spark, duck, small, QUERIES[name], ORACLES[name])
    assert problem is None, problem


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
