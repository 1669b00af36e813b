"""Every catalog query against its SQL in DuckDB, over the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import connect, difference

import __spark_entry__ as entries
from leadmill.plans.catalog import QUERIES
from leadmill.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entries.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    found = difference(spark, connection, SF_DIR, QUERIES[name], ORACLES[name])
    assert found is None


def test_entry(spark):
    scores = [row.score for row in entries.entry(spark).collect()]
    assert len(scores) == 50 and scores == sorted(scores, reverse=True)
