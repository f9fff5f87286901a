import pytest

import __spark_entry__ as entry
from voltlane.plans import queries
from oracle import connect, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert queries.registry().keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(queries.registry()))
def test_query_equals_sql(spark, duck, name):
    assert spark_rows(entry.queries()[name](spark, FOLDER)) == sql_rows(duck, entry.oracle_sql()[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
