"""Every registered query against its SQL on the given tables."""

import oracle
import pytest

import __spark_entry__ as entry

# The queries of the llm folder have their own tests.
NAMES = set(entry.registry.queries())
QUERIES = {name: query for name, query in entry.queries().items() if name in NAMES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in NAMES}
NO_SQL = set()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, con, name):
    problems = oracle.compare(QUERIES[name](spark, sf), con, ORACLES[name])
    assert not problems


def test_entry_returns_the_flagship(spark):
    assert entry.entry(spark).columns == [
        "country_code", "txn_month", "approved_gmv", "interchange_fee_total", "review_txns",
    ]
