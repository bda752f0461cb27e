import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from corpuslm.catalog import ORACLES, QUERIES
from check import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    df = queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows(columns, result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "label", "prediction", "score", "max_score"] and df.count() >= 200
