"""Every registered query against its SQL twin, over whole tables."""

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__
from tweetflow.plans import oracle, registry

# Queries of parts that can be left out are tested beside them.
QUERIES = registry.queries()
SQL = oracle.oracle_sql()

#: Paths, times and sizes differ from run to run.
ROWS_ONLY: dict[str, None] = {}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql_or_says_why_not():
    assert set(QUERIES) - set(SQL) == set(ROWS_ONLY)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert (columns, rows) == duck_rows(connection, SQL[name])
    assert rows


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_gives_rows(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows and ROWS_ONLY[name] in (None, len(rows))


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 20
    assert rows[0].total >= rows[-1].total
