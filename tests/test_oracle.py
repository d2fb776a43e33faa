"""Every registered query with a SQL twin equals DuckDB on the sf0.001 tables (the driver checks sf0.01)."""
import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, rows_of
from tests.conftest import SF_SMALL

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, res.fetchall())
