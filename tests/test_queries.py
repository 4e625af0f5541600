"""Every registered query against its SQL, whole results, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
import oracle
from ranklab.registry.oracles import ORACLES as SQL
from ranklab.registry.queries import REGISTRY as QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry_point.queries().items() and SQL.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    assert oracle.compare(QUERIES[name](spark, sf), con, SQL[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["query_id", "rank", "row_id", "score"]
