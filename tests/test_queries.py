"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as spark_entry
from compare import check, duck
from conftest import SMALL
from cube_queries.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, difference = check(spark, con, SMALL, QUERIES[name], ORACLES.get(name))
    assert difference is None
    assert rows > 0


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_places_of_many_members_are_numbered_in_ranges(spark):
    folder = SMALL.replace("0.001", "0.01")
    placed = QUERIES["numeric_order"](spark, folder)
    assert "__range" in placed._jdf.queryExecution().analyzed().toString()
    rows, difference = check(spark, duck(folder), folder, QUERIES["numeric_order"], ORACLES["numeric_order"])
    assert difference is None and rows > 2000
