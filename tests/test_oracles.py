import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SLOW = {"evaluate_random_forest", "evaluate_logistic", "evaluate_unsupervised"}


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_its_sql(spark, folder, connection, name):
    problem = compare(spark, connection, entry.queries()[name], entry.oracle_sql()[name], folder)
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_query_without_sql_gives_rows(spark, folder, name):
    assert entry.queries()[name](spark, folder).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1000
