"""Every query over the small tables, against its SQL where it has one."""

import duckdb
import pytest

import check
from __spark_entry__ import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
NAMES = [name for name in queries() if name.startswith("op") and name[2].isdigit()]


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in NAMES) == list(range(1, len(NAMES) + 1))
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", [name for name in NAMES if name in oracle_sql()])
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = queries()[name](spark, SMALL).toPandas()
    assert len(found) and not check.difference(found, duck.execute(oracle_sql()[name]).df())


@pytest.mark.parametrize("name", [name for name in NAMES if name not in oracle_sql()])
def test_one_row_for_each_row(spark, name):
    table = "pages" if "url" in name else "documents"
    found = queries()[name](spark, SMALL)
    assert found.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
