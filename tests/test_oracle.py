"""Every registered query against its SQL twin (DuckDB) at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import digest

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
FAST = os.environ.get("RIVULET_ORACLE_KEYS")
KEYS = sorted(FAST.split(",")) if FAST else sorted(SQL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[key])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(cols, rows)[0] == digest(dcols, drows)[0]


def test_rows_only_queries_run(spark):
    for key in sorted(set(E.queries()) - set(SQL)):
        assert E.queries()[key](spark, SF).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns
