"""Every query with a SQL twin equals DuckDB on the sf0.001 tables
(rows, column names, values after the same normalisation as the driver's
order-insensitive compare)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from tessera.plans.registry import TABLES  # noqa: E402

from conftest import SF  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(SQL[name])
    dnames = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dnames)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows, False) == rows_of(dnames, drows, False)


def test_every_query_runs_and_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "id_cliente" in df.columns
    assert set(SQL) <= set(E.queries())
