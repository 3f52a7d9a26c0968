"""Every catalog query against its SQL counterpart."""

import __spark_entry__ as entry
import pytest
from compare import connect, difference

from skylane.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_entry_has_rows(spark):
    flagship = entry.entry(spark)
    assert flagship.filter("temp_c is not null").limit(1).count() == 1
    assert flagship.count() > 0


def test_entry_has_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
