"""Every registered query against its check SQL, on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from proofs import PROOFS
from tools.check_queries import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_its_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_every_query_has_check_sql():
    assert set(PROOFS) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
