"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from areaflow.queries import ORACLES, QUERIES
from tests import oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, con, sf_dir):
    assert oracle.mismatches(con, QUERIES[name](spark, sf_dir), ORACLES[name]) == []
