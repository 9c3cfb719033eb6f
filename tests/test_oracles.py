"""Every query with an oracle gives DuckDB's rows."""

import pytest

from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, duck, sf):
    assert compare(name, spark, duck, sf) == ""
