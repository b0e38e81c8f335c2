"""Every registered query against its SQL check, on the smallest data folder."""

import duckdb
import pytest

from __spark_entry__ import entry
from claimweave.registry.oracles import ORACLES
from claimweave.registry.queries import QUERIES
from check_queries import TABLES, normalised

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_check(spark, db, name):
    mine = QUERIES[name](spark, SF).toPandas()
    expected = db.execute(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(expected.columns)
    assert len(mine) == len(expected)
    assert normalised(mine) == normalised(expected)


def test_entry(spark):
    frame = entry(spark)
    assert len(frame.columns) == 91 and frame.count() > 0
