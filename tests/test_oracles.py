"""Every named query with an oracle, on the smallest tables."""

import os

import duckdb
import pytest
from check_oracles import TABLES, compare

import __spark_entry__ as driver

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


def test_catalogue_is_consistent():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_oracle(spark, sql, name):
    df = driver.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    cur = sql.execute(driver.oracle_sql()[name])
    assert compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) == "ok"
