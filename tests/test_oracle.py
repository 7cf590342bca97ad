"""Every query with a SQL twin gives the same rows; every other query runs."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from tests.conftest import FOLDER

ORACLE = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert compare(got, duck.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["user_id", "item_id", "score", "rank"]
