"""Every registered query on the smallest tables, against its SQL where it has one."""

import __spark_entry__ as entry
import pytest
from check import compare, database

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    problem = compare(db, spark, FOLDER, QUERIES[name], SQL.get(name))
    assert problem is None or problem == "no rows", problem


def test_entry(spark):
    assert entry.entry(spark).columns == ["facet", "key", "count", "doc_count_error", "other_count"]
