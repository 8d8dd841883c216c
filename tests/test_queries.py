"""Every registered query against its SQL on DuckDB."""

import pytest
from compare import connect, difference
from conftest import SF

import __spark_entry__ as entry

SQL = entry.oracle_sql()
OPTIONAL = entry.llm_queries.QUERIES.keys() | {"pipeline"} if entry.llm_queries else set()
QUERIES = {n: q for n, q in entry.queries().items() if n not in OPTIONAL}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) - OPTIONAL


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 106
