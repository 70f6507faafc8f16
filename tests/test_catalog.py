"""Every query of the catalog against its independent SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, difference
from millrace.catalog import QUERIES
from millrace.oracle import ORACLES
from tests.conftest import SMALL_TABLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{SMALL_TABLES}/{name}.parquet'"
        )
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL_TABLES).toPandas()
    assert len(result) > 0
    assert difference(result, duck.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
