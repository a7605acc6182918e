"""Every query gives the rows of its SQL, and has one."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry_points
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, duck, name):
    assert difference(duck, ORACLES[name], QUERIES[name](spark, sf_dir)) is None


def test_entry(spark):
    assert not entry_points.entry(spark).isEmpty()
