"""Every query against its SQL statement."""

import pytest
from compare import SMALL, connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from stockweave.plans.catalog import QUERIES

STATEMENTS = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_statement(spark, duck, small, name):
    assert differences(queries()[name](spark, small), duck, STATEMENTS[name]) == ""


def test_statements_cover_queries():
    assert set(QUERIES) <= set(STATEMENTS)
    assert set(STATEMENTS) <= set(queries())


def test_entry_gives_the_feature_table(spark):
    df = entry(spark)
    assert len(df.columns) == 40 and df.limit(1).count() == 1
